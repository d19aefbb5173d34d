"""Leakage checks between an evaluation set and what a system may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as X
from ..session import is_small, lookup_join, materialize, measured, size_measures


def duplicate_ids(golden: DataFrame) -> DataFrame:
    """One row: rows, distinct conversations and surplus rows."""
    return golden.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("conversation_id").alias("n_distinct")).withColumn(
        "duplicates", F.col("n") - F.col("n_distinct"))


def unregistered_ids(golden: DataFrame, held_out: DataFrame) -> DataFrame:
    """Evaluation conversations that are missing from the held-out list."""
    return golden.select("conversation_id").distinct().join(held_out, "conversation_id", "left_anti")


def id_overlap(golden: DataFrame, cases: DataFrame) -> DataFrame:
    """Evaluation conversations that are also in the index."""
    ids = golden.select(F.col("conversation_id").alias("case_id")).distinct()
    return cases.select("case_id").join(ids, "case_id", "left_semi")


def normalized(text: str):
    return F.lower(X.normalize_edges(F.col(text)))


def text_overlap(reference: DataFrame, reference_id: str, reference_text: str, golden: DataFrame,
                 golden_text: str) -> DataFrame:
    """Rows of the reference pool whose text, trimmed and lowercased, is also an evaluation text."""
    # joined by digest, so that whole texts are neither keys nor moved; SHA-256 stands for the text
    digest = lambda text: F.sha2(normalized(text), 256)
    texts = golden.select(digest(golden_text).alias("_digest")).distinct()
    pool = reference.select(reference_id, normalized(reference_text).alias("normalized"), digest(reference_text).alias("_digest"))
    return lookup_join(pool, texts, "_digest").select(reference_id, "normalized")


def words_of(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), rf"[{X.SPACE}]+"), lambda w: w != "")


def shingles(words: Column, k: int) -> Column:
    """The different runs of k words of a text; a shorter text is one run. Pass the words as a column of their own, so that they are cut once."""
    short = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(words) >= k, F.array_distinct(X.word_ngrams(words, k, k))).otherwise(short)


def near_duplicates(pool: DataFrame, pool_id: str, pool_text: str, held: DataFrame, held_id: str, held_text: str,
                    similarity: float = 0.8, k: int = 5, contained: bool = False) -> DataFrame:
    """(pool_id, held_id, similarity): for every row of the pool the most similar held-out row, if it reaches the limit.

    Similarity is the Jaccard index of the k-word shingles, or with `contained` the part of the held-out row's
    shingles that the pool row has. Ties: the smaller held-out id. Exact: shingles are put in order from the rarest; two
    rows that reach the limit share one of the first n - limit + 1 of each (contained: of the held-out row), so
    only rows that meet there are compared, and what many rows share pairs nobody. Rows with equal shingles are compared once.
    """
    def sets(df: DataFrame, key: str, text: str) -> DataFrame:
        cut = df.select(F.col(key).alias("id"), words_of(text).alias("words")).filter(F.size("words") > 0)
        cut = cut.select("id", F.array_sort(F.transform(shingles(F.col("words"), k), lambda w: F.xxhash64(w))).alias("set"))
        return materialize(cut.withColumn("same", F.sha2(F.array_join(F.transform("set", lambda x: x.cast("string")), ","), 256)), "sets")

    mine, theirs = sets(pool, pool_id, pool_text), sets(held, held_id, held_text)
    # one row for each set, with a number, which is shorter than the digest in all that follows
    one = lambda df: df.groupBy("same").agg(F.min_by("set", "id").alias("set"), F.min("id").alias("id")).withColumn("number", F.monotonically_increasing_id())
    left, right = materialize(one(mine), "poolsets"), materialize(one(theirs), "heldsets")
    flat = lambda df: df.select("number", F.size("set").alias("n"), F.explode("set").alias("shingle"))
    # a shingle of one side only is in no pair: it comes first in every row's order, and is left out at once
    held_often, sizes = measured(flat(right).groupBy("shingle").agg(F.count(F.lit(1)).alias("held")), "heldshingles", rows=F.count(F.lit(1)), bytes=F.count(F.lit(1)) * 32)
    met = materialize(lookup_join(flat(left), held_often, "shingle", salts=1, small=is_small(sizes)), "met")
    often = materialize(met.groupBy("shingle").agg((F.count(F.lit(1)) + F.first("held")).alias("df")), "often")
    order = Window.partitionBy("number").orderBy("df", "shingle")
    limit = F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-9))

    def prefix(shared: DataFrame) -> DataFrame:
        many = F.count(F.lit(1)).over(Window.partitionBy("number"))
        placed = shared.withColumn("place", F.col("n") - many + F.row_number().over(order))  # those of one row come first
        return placed.filter(F.col("place") <= F.col("n") - limit + 1).select("shingle", "number", "n")

    a = (met if contained else prefix(met.join(often, "shingle"))).select("shingle", F.col("number").alias("pool_number"), "n")
    b = prefix(flat(right).join(often, "shingle")).select("shingle", F.col("number").alias("held_number"), F.col("n").alias("m"))
    pairs = a.join(b, "shingle")
    if not contained:
        pairs = pairs.filter(F.least("n", "m") >= F.lit(similarity) * F.greatest("n", "m"))
    pairs = pairs.select("pool_number", "held_number").distinct()
    full = (pairs.join(left.select(F.col("number").alias("pool_number"), F.col("same").alias("pool_same"), F.col("set").alias("x")), "pool_number")
            .join(right.select(F.col("number").alias("held_number"), F.col("set").alias("y"), F.col("id").alias("held_id")), "held_number"))
    both = F.size(F.array_intersect("x", "y"))
    value = both / (F.size("y") if contained else F.size("x") + F.size("y") - both)
    best = (full.select("pool_same", "held_id", value.alias("similarity")).filter(F.col("similarity") >= similarity)
            .groupBy("pool_same").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "held_id")).alias("best")))
    return mine.select(F.col("id").alias(pool_id), F.col("same").alias("pool_same")).join(best, "pool_same").select(
        pool_id, F.col("best.held_id").alias("held_id"), F.round(-F.col("best.s"), 6).alias("similarity"))


def label_in_input(golden: DataFrame) -> DataFrame:
    """Evaluation messages that contain the name of a target field."""
    return golden.filter(
        F.col("customer_message").contains("gold_intent") | F.col("customer_message").contains("gold_decision")).select(
        "id", "customer_message")


def leakage_report(golden: DataFrame, held_out: DataFrame, cases: DataFrame, pool: DataFrame) -> DataFrame:
    """(check, violations) for every check; all must be 0 in a clean split."""
    spark = golden.sparkSession
    counts = [
        ("duplicate_ids", duplicate_ids(golden).select("duplicates")),
        ("unregistered_ids", unregistered_ids(golden, held_out).agg(F.count(F.lit(1)))),
        ("id_overlap", id_overlap(golden, cases).agg(F.count(F.lit(1)))),
        ("text_overlap", text_overlap(pool, "conversation_id", "customer_cleaned_issue", golden, "customer_message")
         .agg(F.count(F.lit(1)))),
        ("label_in_input", label_in_input(golden).agg(F.count(F.lit(1)))),
    ]
    report = None
    for name, one in counts:
        row = one.toDF("violations").select(F.lit(name).alias("check"), F.col("violations").cast("bigint"))
        report = row if report is None else report.unionByName(row)
    return report
