"""Whole-word keyword predicates over an ordered intent dictionary."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import WORD

Dictionary = list[tuple[str, list[str]]]


def whole_word_pattern(word: str) -> str:
    """The word with no word character on either side. The word itself comes first, because it fails fastest."""
    literal = re.sub(r"([.^$*+?{}\[\]\\|()\-])", r"\\\1", word)
    return rf"{literal}(?<![{WORD}]{literal})(?![{WORD}])"


def has_keyword(c: Column, words: list[str]) -> Column:
    """Whole-word test in any case. A plain search spares the texts without the word the regex."""
    lowered, hit = F.lower(c), F.lit(False)
    for word in (w.lower() for w in words):
        hit = hit | (lowered.contains(word) & lowered.rlike(whole_word_pattern(word)))
    return F.coalesce(hit, F.lit(False))


def first_match(c: Column, dictionary: Dictionary, default: str) -> Column:
    """The first intent, in dictionary order, that has a keyword in the text."""
    return F.coalesce(*[F.when(has_keyword(c, ws), F.lit(i)) for i, ws in dictionary], F.lit(default))


def all_matches(c: Column, dictionary: Dictionary) -> Column:
    """Every intent with a keyword in the text, in dictionary order."""
    return F.array_compact(F.array(*[F.when(has_keyword(c, ws), F.lit(i)) for i, ws in dictionary]))
