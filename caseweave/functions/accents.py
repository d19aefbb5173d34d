"""Accent folding: compatibility decomposition without combining marks.

Spark has no such function, so the one-to-one part of the mapping is built from the
Unicode database as a rule and runs as `translate` in the JVM. Only texts that hold a
character with a longer decomposition (ligatures, fractions, Hangul) go through an
Arrow-batched Python function; every other row sends it a null.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def fold(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


@lru_cache(maxsize=1)
def _tables() -> tuple[str, str]:
    """Characters that change and, at the same places, what they become.

    MARK stands for a longer decomposition. Characters that vanish come last and have no partner.
    """
    source, target, drop = [], [], []
    for code in range(0x80, 0x30000):
        if 0xD800 <= code < 0xE000:
            continue
        ch = chr(code)
        folded = fold(ch)
        if folded == "":
            drop.append(ch)
        elif folded != ch:
            source.append(ch)
            target.append(folded if len(folded) == 1 else MARK)
    return "".join(source + drop), "".join(target)


MARK = "\U0010ffff"  # not a character; a text that holds it anyway takes the slow path


def _fold_rows():
    # Built inside a function so that it travels to the executors by value.
    def rows(texts: pd.Series) -> pd.Series:
        import unicodedata as u

        return texts.map(lambda t: t if t is None else "".join(
            ch for ch in u.normalize("NFKD", t) if not u.combining(ch)))

    return F.pandas_udf(rows, T.StringType())


def strip_accents(c: Column) -> Column:
    source, target = _tables()
    plain = c.rlike(r"^\p{ASCII}*$")
    simple = F.translate(c, source, target)
    special = ~plain & simple.contains(MARK)
    return F.when(plain, c).when(special, _fold_rows()(F.when(special, c))).otherwise(simple)
