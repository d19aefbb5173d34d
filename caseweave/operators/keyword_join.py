"""Keyword labels from a dictionary of any size: a table of word sequences joined to those of the texts.

The expressions in `functions.keywords` test every keyword against every text, which suits some dozens. Here a text is cut once
into its runs of word characters and the runs between them, and its sequences of one, two, ... words, as long as keywords are,
meet the keywords by an equality join. The work grows with the words and the matches, not with texts x keywords.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keywords import Dictionary, has_keyword
from ..functions.text import WORD
from ..session import is_small, lookup_join, measured, size_measures

RUNS = rf"[{WORD}]+|[^{WORD}]+"
IS_WORD = rf"^[{WORD}]"


def keyword_table(spark: SparkSession, dictionary: Dictionary) -> DataFrame:
    """(priority, intent, keyword) rows of an ordered dictionary."""
    rows = [(p, intent, word) for p, (intent, words) in enumerate(dictionary, start=1) for word in words]
    return spark.createDataFrame(rows, "priority int, intent string, keyword string")


def runs_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(RUNS), F.lit(0))


def core_of(runs: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(runs, first + 1, last - first + 1), "")


def prepared(keywords: DataFrame) -> DataFrame:
    """(core, words, priority, intent, before, after): each keyword from its first word to its last, how many words that are, and
    what stands outside of it. Keywords without a word character, empty and null ones drop out here."""
    runs = F.col("runs")
    cut = keywords.select("priority", "intent", runs_of(F.col("keyword")).alias("runs")).filter(F.exists("runs", lambda r: r.rlike(IS_WORD)))
    first = F.when(runs[0].rlike(IS_WORD), 0).otherwise(1)
    last = F.size(runs) - F.when(F.element_at(runs, -1).rlike(IS_WORD), 1).otherwise(2)
    cut = cut.withColumns({"first": first, "last": last})
    return cut.select(core_of(runs, F.col("first"), F.col("last")).alias("core"), F.floor((F.col("last") - F.col("first")) / 2 + 1).cast("int").alias("words"),
                      "priority", "intent", F.when(F.col("first") > 0, runs[0]).alias("before"),
                      F.when(F.col("last") < F.size(runs) - 1, F.element_at(runs, -1)).alias("after")).distinct()


def sequences(runs: Column, words: int, sides: bool = True) -> Column:
    """Every sequence of so many words of a text: (core, left, leftmost, right, rightmost), with the runs beside it and whether the
    text begins or ends with them; without `sides` only (core)."""
    n, span = F.size(runs), 2 * words - 2
    first = F.when(runs[0].rlike(IS_WORD), 0).otherwise(1)  # from there on every second run is a word
    core = lambda i: (F.concat(*[F.get(runs, i + j) for j in range(span + 1)]) if words <= 4 else core_of(runs, i, i + span)).alias("core")
    one = lambda i: F.struct(core(i), F.when(i > 0, F.get(runs, i - 1)).alias("left"), (i == 1).alias("leftmost"),
                             F.get(runs, i + span + 1).alias("right"), (i + span + 2 == n).alias("rightmost")) if sides else F.struct(core(i))
    return F.when(n - span > first, F.transform(F.sequence(first, n - 1 - span, F.lit(2)), one))


def beside() -> Column:
    """The signs before and after a keyword's words stand in the text, and no word character touches them on the outside."""
    k = F.col("k")
    before = k["before"].isNull() | (F.col("left").endswith(k["before"]) & ((F.length("left") > F.length(k["before"])) | F.col("leftmost")))
    after = k["after"].isNull() | (F.col("right").startswith(k["after"]) & ((F.length("right") > F.length(k["after"])) | F.col("rightmost")))
    return F.coalesce(before & after, F.lit(False))


def keyword_hits(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """(key, priority, intent): every intent of the table that has a keyword in the text, as a whole word in any case.

    A keyword's words follow each other with exactly the characters that stand between them in the keyword. A keyword
    without any word character is tested as an expression, one each. Every key should be one row; null texts match nothing.
    The table of keywords is broadcast if it is small, else spread over salts.
    """
    side = prepared(keywords)
    signed = F.max(F.col("before").isNotNull() | F.col("after").isNotNull())
    side, sizes = measured(side, "keywords", signed=signed, **size_measures(side))
    lengths = sorted(r["words"] for r in side.select("words").distinct().collect())  # one for each number of words
    grouped = side.groupBy("core").agg(F.collect_list(F.struct("priority", "intent", "before", "after")).alias("listed"))
    runs = df.select(key, runs_of(F.col(text)).alias("runs")).filter(F.size("runs") > 0)
    parts = [F.coalesce(sequences(F.col("runs"), n, sizes["signed"]), F.array()) for n in lengths]
    hits = df.select(key, F.lit(0).alias("priority"), F.lit("").alias("intent")).limit(0)
    if parts:
        said = runs.select(key, F.explode(F.concat(*parts)).alias("s")).select(key, "s.*")
        met = lookup_join(said, grouped, "core", small=is_small(sizes)).withColumn("k", F.explode("listed"))
        hits = (met.filter(beside()) if sizes["signed"] else met).select(key, "k.priority", "k.intent")
    lowered = F.lower("keyword")
    signs = keywords.filter(~lowered.rlike(rf"[{WORD}]") & (lowered != "")).select("priority", "intent", lowered.alias("keyword")).distinct()
    for sign in signs.toLocalIterator():
        hits = hits.unionByName(df.filter(has_keyword(F.col(text), [sign["keyword"]])).select(
            key, F.lit(sign["priority"]).alias("priority"), F.lit(sign["intent"]).alias("intent")))
    return hits.distinct()


def all_matches(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """(key, intents): for every row the intents that have a keyword in its text, in the order of their priority."""
    hits = keyword_hits(df, key, text, keywords).groupBy(key).agg(F.array_sort(F.collect_set(F.struct("priority", "intent"))).alias("hits"))
    found = df.select(key).join(hits, key, "left")
    return found.select(key, F.coalesce(F.transform("hits", lambda h: h["intent"]), F.array().cast("array<string>")).alias("intents"))


def first_match(df: DataFrame, key: str, text: str, keywords: DataFrame, default: str) -> DataFrame:
    """(key, intent): the first intent by priority that has a keyword in the text, else the default."""
    return all_matches(df, key, text, keywords).select(key, F.coalesce(F.get("intents", F.lit(0)), F.lit(default)).alias("intent"))


def single_match(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """(key, intent): only the rows whose text matches exactly one intent."""
    return all_matches(df, key, text, keywords).filter(F.size("intents") == 1).select(key, F.col("intents")[0].alias("intent"))


def frequency(df: DataFrame, key: str, text: str, keywords: DataFrame, default: str) -> DataFrame:
    """(intent, n): how many texts have the intent as their first match."""
    return first_match(df, key, text, keywords, default).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))
