"""Profiles that are kept day by day: small mergeable sketches in place of another pass over all texts.

A day's texts give one row of sums and sketches (per brand for vocabularies). Any range of days is merged from these rows alone,
and a day that is run again replaces its row. Counts, means, minima and maxima are exact; medians and vocabulary sizes
are within the bounds below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X

KLL_K = 400
RANK_ERROR = 0.01  # of a median's rank, at 99 % confidence, for that k
HLL_LOG_K = 14
SIZE_ERROR = 0.025  # of a vocabulary's size: three standard errors, 1.04 / sqrt(2^14) each


def text_sketches(df: DataFrame, day: str, text: str = "text") -> DataFrame:
    """(day, n, chars, words, chars_min, chars_max, chars_kll, words_kll): one row for each day that has a text. Null texts do not count."""
    sizes = df.filter(F.col(text).isNotNull()).select(F.col(day).cast("date").alias("day"), F.length(text).cast("long").alias("c"),
                                                      X.word_count(F.col(text)).cast("long").alias("w"))
    return sizes.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("chars"), F.sum("w").alias("words"), F.min("c").alias("chars_min"), F.max("c").alias("chars_max"),
        F.kll_sketch_agg_bigint("c", F.lit(KLL_K)).alias("chars_kll"), F.kll_sketch_agg_bigint("w", F.lit(KLL_K)).alias("words_kll"))


def vocabulary_sketches(mentions: DataFrame, day: str) -> DataFrame:
    """(day, brand, words_hll): the long words of a day's messages to a brand, as `profile.vocabulary_diversity` takes them."""
    long_word = rf"(?<![^{X.SPACE}])[^{X.SPACE}@][^{X.SPACE}]{{3,}}"
    words = mentions.select(F.col(day).cast("date").alias("day"), "brand", F.explode(F.regexp_extract_all("text", F.lit(long_word), F.lit(0))).alias("word"))
    return words.groupBy("day", "brand").agg(F.hll_sketch_agg(F.lower("word"), F.lit(HLL_LOG_K)).alias("words_hll"))


def write_days(sketches: DataFrame, path: str) -> None:
    """Store the rows by day; days that are in `sketches` are replaced, others stay."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored rows from the first to the last day, both included."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("day") >= F.lit(first).cast("date"))
    return rows if last is None else rows.filter(F.col("day") <= F.lit(last).cast("date"))


def text_statistics(sketches: DataFrame) -> DataFrame:
    """The columns of `profile.text_statistics`, and n, of all the days together. Without texts n is 0 and the others are null."""
    merged = sketches.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("chars").alias("chars"), F.sum("words").alias("words"), F.min("chars_min").alias("char_length_min"),
        F.max("chars_max").alias("char_length_max"), F.kll_merge_agg_bigint("chars_kll").alias("c"), F.kll_merge_agg_bigint("words_kll").alias("w"))
    mean = lambda c: F.round(F.try_divide(F.col(c), F.col("n")), 2)
    median = lambda c: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint(c, F.lit(0.5)))
    return merged.select("n", mean("chars").alias("char_length_mean"), median("c").alias("char_length_median"), "char_length_min", "char_length_max",
                         mean("words").alias("word_count_mean"), median("w").alias("word_count_median"))


def vocabulary_diversity(sketches: DataFrame) -> DataFrame:
    """(brand, customer_vocabulary_diversity) of all the days together."""
    return sketches.groupBy("brand").agg(F.hll_sketch_estimate(F.hll_union_agg("words_hll")).alias("customer_vocabulary_diversity"))
