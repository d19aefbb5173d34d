"""A case index that is kept up: appended segments, deletions, and their compaction, under a manifest of generations.

A segment holds new cases with their term counts, so a text is cut once in its life. Which cases are live follows from the
manifest; document frequencies, weights and postings are made of the live counts when a generation is opened first, and then
kept beside it. Files are only added: readers of an older generation are not disturbed, and of two writers of one
generation the second fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import fresh_path, materialize
from . import retrieve as R
from .features import Analyzer, term_counts

MANIFEST = "generation long, kind string, folder string"


def generations(spark: SparkSession, path: str) -> list:
    """The manifest in order: one row for each append, deletion or compaction."""
    if not R.table_exists(spark, f"{path}/manifest/{1:08d}"):
        return []
    return sorted(spark.read.schema(MANIFEST).json(f"{path}/manifest/*").collect(), key=lambda r: r["generation"])  # one row each


def _commit(spark: SparkSession, path: str, kind: str, folder: str) -> int:
    number = len(generations(spark, path)) + 1
    row = spark.createDataFrame([(number, kind, folder)], MANIFEST)
    row.coalesce(1).write.mode("error").json(f"{path}/manifest/{number:08d}")
    return number


def append_cases(cases: DataFrame, path: str, analyzer: Analyzer = R.RETRIEVAL) -> int:
    """Add cases as a segment. A case_order that is there already is replaced. Returns the new generation."""
    spark, folder = cases.sparkSession, fresh_path(cases.sparkSession, "segment").rsplit("/", 1)[1]
    cases.write.parquet(f"{path}/{folder}/cases")
    stored = spark.read.parquet(f"{path}/{folder}/cases")
    term_counts(stored, "case_order", "customer_issue", analyzer).write.parquet(f"{path}/{folder}/counts")
    return _commit(spark, path, "append", folder)


def delete_cases(case_orders: DataFrame, path: str) -> int:
    """Take the cases with these case_orders out, such as those of newly held-out conversations. They may be added again later."""
    spark, folder = case_orders.sparkSession, fresh_path(case_orders.sparkSession, "deleted").rsplit("/", 1)[1]
    case_orders.select("case_order").distinct().write.parquet(f"{path}/{folder}/deleted")
    return _commit(spark, path, "delete", folder)


def live(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(cases, counts) of the newest generation: of every case_order the last segment's row, unless it was deleted after that."""
    rows = generations(spark, path)
    last = max((i for i, r in enumerate(rows) if r["kind"] == "compact"), default=0)
    rows = rows[last:]

    def read(kinds: tuple, name: str) -> DataFrame | None:
        found = None
        for r in rows:
            if r["kind"] in kinds:
                part = spark.read.parquet(f"{path}/{r['folder']}/{name}").withColumn("generation", F.lit(r["generation"]))
                found = part if found is None else found.unionByName(part)
        return found

    cases, counts, deleted = read(("append", "compact"), "cases"), read(("append", "compact"), "counts"), read(("delete",), "deleted")
    if cases is None:
        raise ValueError(f"no cases were ever appended to {path}")
    if len(rows) == 1:
        return cases.drop("generation"), counts.drop("generation")
    newest = cases.groupBy("case_order").agg(F.max("generation").alias("generation"))
    if deleted is not None:
        gone = deleted.groupBy("case_order").agg(F.max("generation").alias("gone"))
        newest = newest.join(gone, "case_order", "left").filter("gone is null or gone < generation").drop("gone")
    newest = materialize(newest, "live")
    return tuple(t.join(newest, ["case_order", "generation"], "left_semi").drop("generation") for t in (cases, counts))


def open_index(spark: SparkSession, path: str, analyzer: Analyzer = R.RETRIEVAL) -> R.CaseIndex:
    """The index of the newest generation, equal to one built of its live cases at once."""
    built = f"{path}/built-{len(generations(spark, path)):08d}"
    if not R.table_exists(spark, f"{built}/done"):
        cases, counts = live(spark, path)
        R.index_from_counts(cases, counts, built, analyzer)
        spark.range(1).write.mode("overwrite").parquet(f"{built}/done")
    return R.load_index(spark, built, analyzer)


def compact(spark: SparkSession, path: str) -> int:
    """Write the live cases and counts as one segment, from which later generations start."""
    folder = fresh_path(spark, "compact").rsplit("/", 1)[1]
    for name, table in zip(("cases", "counts"), live(spark, path)):
        table.write.parquet(f"{path}/{folder}/{name}")
    return _commit(spark, path, "compact", folder)


def _content(cases: DataFrame) -> DataFrame:
    return cases.select("case_order", F.xxhash64(*R.CASE_COLUMNS).alias("content"))


def fingerprint(cases: DataFrame) -> tuple:
    """Rows, and two sums over a hash of their contents, in any order."""
    content = _content(cases)
    return tuple(content.agg(F.count(F.lit(1)), F.bit_xor("content"), F.sum(F.col("content").cast("decimal(38,0)"))).first())


def is_current(cases: DataFrame, path: str) -> bool:
    """Whether the newest generation holds exactly these cases."""
    spark = cases.sparkSession
    return bool(generations(spark, path)) and fingerprint(cases) == fingerprint(live(spark, path)[0])


def refresh(cases: DataFrame, path: str, analyzer: Analyzer = R.RETRIEVAL) -> R.CaseIndex:
    """Open the index of exactly these cases: what is new or changed is appended, what is gone deleted, and the rest is reused."""
    spark = cases.sparkSession
    cases = cases.select(*R.CASE_COLUMNS)
    if not generations(spark, path):
        append_cases(cases, path, analyzer)
    elif not is_current(cases, path):
        stored = materialize(_content(live(spark, path)[0]), "stored")
        changed = cases.withColumn("content", F.xxhash64(*R.CASE_COLUMNS)).join(stored, ["case_order", "content"], "left_anti").drop("content")
        gone = materialize(stored.select("case_order").join(cases, "case_order", "left_anti"), "gone")
        changed = materialize(changed, "changed")
        if changed.first():
            append_cases(changed, path, analyzer)
        if gone.first():
            delete_cases(gone, path)
    return open_index(spark, path, analyzer)
