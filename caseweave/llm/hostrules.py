"""Quality rules per document and per host, host rates shrunk towards the corpus by an empirical beta prior."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import join_lookup, materialize, send_code, text_of

SYMBOLS = "#*$%&|<>"  # fixed values of the rule
BLANKS = " \t\n\v\f\r"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


class Limits(NamedTuple):
    """When a document fails a rule, and when a host does."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 20  # symbols against words
    dup_line_percent: int = 50  # repeated lines against lines with a word
    host_rate: float = 0.5  # shrunken failure rate from which a host is rejected


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """How many words stand in a window of `width` words that occurs twice or more, the first included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    windows = ids[:n]
    for k in range(1, width):  # renumber, so that products stay exact however many words there are
        key = windows * len(known) + ids[k:n + k]
        windows = np.unique(key, return_inverse=True)[1] if k < width - 1 and len(known) ** width >= 2 ** 62 else key
    counts, inverse = np.unique(windows, return_inverse=True, return_counts=True)[2:0:-1]
    starts = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k:n + k] |= starts
    return int(covered.sum())


def text_statistics(text: str) -> tuple[int, int, int, int, int, int]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at space and \t to \r only
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup,
            repeated_window_words(words), lines)


def statistics(text: Column) -> Column:
    @F.pandas_udf(STATS)
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_statistics(t) for t in texts], columns=[c.split()[0] for c in STATS.split(", ")], dtype="int64")

    return count(text)


def failures(limits: Limits, s: str = "stats") -> dict[str, Column]:
    c = lambda name: F.col(f"{s}.{name}")
    return {"short": c("n_words") < limits.min_words,
            "repetitive": 100 * c("n_repeat_words") > limits.repeat_percent * c("n_words"),
            "symbols": 100 * c("n_symbols") > limits.symbol_percent * c("n_words"),
            "dup_lines": 100 * c("n_dup_lines") > limits.dup_line_percent * c("n_lines")}


def host_of(source: str = "source") -> Column:
    """The host of a URL, else the whole value, in lower case; null counts as the empty host."""
    bare = F.regexp_replace(F.coalesce(F.col(source).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?", "")
    return F.lower(F.regexp_extract(bare, r"^[^/?#:]*", 0))


def host_verdicts(judged: DataFrame, limits: Limits) -> DataFrame:
    """host, n_docs, rate, rejected from rows (host, failed boolean).

    The prior is a beta distribution fitted to the hosts' raw rates by moments: their mean m weighted by
    documents, and the variance v between hosts beyond what sampling explains. Its weight is m(1-m)/v - 1, held between
    1 and 1e6 documents. A host's rate is (failed + m * weight) / (docs + weight), so a host of a few documents
    stays near m.
    """
    hosts = materialize(judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")), "hosts")
    n, f, k = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.count(F.lit(1))).first()
    mean = f / n if n else 0.0
    raw = F.col("n_failed") / F.col("n_docs")
    spread, = hosts.agg(F.sum(F.col("n_docs") * F.pow(raw - F.lit(mean), F.lit(2.0)))).first()
    between = (spread - (k - 1) * mean * (1 - mean)) / n if n else 0.0
    weight = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select("host", "n_docs", rate.alias("host_rate"), (rate >= F.lit(limits.host_rate)).alias("host_rejected"))


def with_failures(docs: DataFrame, limits: Limits) -> DataFrame:
    """All columns of `docs`, with _host, _stats and _rules: the failed rules of the row."""
    send_code(docs.sparkSession)
    out = docs.withColumns({"_host": host_of(), "_stats": statistics(text_of())})
    rules = F.array(*[F.when(test, F.lit(name)) for name, test in failures(limits, "_stats").items()])
    return out.withColumn("_rules", F.array_compact(rules))


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the counts, base_failed, kept, failed_rules, host, host_rate.

    A document goes if it fails a rule itself, or if its host is rejected: the share of the host's documents that
    fail a rule, shrunk by the prior, reaches `host_rate`. The host table is aggregated before it is joined back;
    the join is broadcast only if the table is small, else salted, so one host with most rows is split.

    Null text: no words, fails "short". Null doc_id: judged, id null. Null source: the empty host. Repeated rows
    are judged each and count each for their host. Empty table: no rows. Other columns are ignored.
    """
    rows = with_failures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source"), limits).drop("text", "source")
    rows = materialize(rows, "rules")
    hosts = host_verdicts(rows.select(F.col("_host").alias("host"), (F.size("_rules") > 0).alias("failed")), limits)
    out = join_lookup(rows.withColumnRenamed("_host", "host"), hosts, "host")
    base = F.arrays_overlap("_rules", F.array(F.lit("short"), F.lit("repetitive")))
    return out.select("doc_id", *[F.col(f"_stats.{n}") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      base.alias("base_failed"), ((F.size("_rules") == 0) & ~F.col("host_rejected")).alias("kept"),
                      F.col("_rules").alias("failed_rules"), "host", "host_rate")


def keep(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with their own columns.

    The texts are read twice and never shuffled: once for the host table, once to test each row against it.
    Only rejected hosts are joined."""
    columns = docs.columns
    narrow = with_failures(docs.select("text", "source"), limits)
    hosts = host_verdicts(narrow.select(F.col("_host").alias("host"), (F.size("_rules") > 0).alias("failed")), limits)
    rows = with_failures(docs, limits).filter(F.size("_rules") == 0)
    bad = hosts.filter("host_rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    return join_lookup(rows, bad, "_host").filter(F.col("_bad").isNull()).select(*columns)
