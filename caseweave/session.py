"""Session, shared work folder and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 2_000_000


def local_session(cpus: str = "*", memory: str = "20g") -> SparkSession:
    """A session for tests and benchmarks. On a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("caseweave")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """The shared folder that `spark.checkpoint.dir` names; set here only for local runs that lack it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
            configured = tempfile.mkdtemp(prefix="caseweave-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer real file sizes.
    """
    return measured(df, name)[0]


def measured(df: DataFrame, name: str, path: str | None = None, **measures) -> tuple[DataFrame, dict]:
    """`materialize`, with aggregates that are taken while the rows are written."""
    path = path or fresh_path(df.sparkSession, name)
    result = {}
    if measures:
        seen = Observation(name)
        df.observe(seen, *[c.alias(k) for k, c in measures.items()]).write.mode("overwrite").parquet(path)
        result = seen.get
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), result


def size_measures(df: DataFrame) -> dict:
    return {"rows": F.count(F.lit(1)), "bytes": F.sum(sum((_width(df, f) for f in df.schema.fields), F.lit(0)))}


def is_small(sizes, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    return sizes["rows"] <= rows and (sizes["bytes"] or 0) <= size


def fits_broadcast(df: DataFrame) -> bool:
    """Measure a lookup side before it may be broadcast: its row count and the bytes of its columns."""
    return is_small(df.agg(*[c.alias(k) for k, c in size_measures(df).items()]).first())


def small_side(df: DataFrame, name: str) -> DataFrame:
    """The table written and measured, marked for broadcast if it is small."""
    df, sizes = measured(df, name, **size_measures(df))
    return F.broadcast(df) if is_small(sizes) else df


def _width(df: DataFrame, field):
    kind = field.dataType.typeName()
    c = df[field.name]
    if kind == "string":
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if kind in ("array", "map"):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
    return F.lit(16)


def lookup_join(left: DataFrame, side: DataFrame, key: str, how: str = "inner", salts: int = 16,
                small: bool | None = None) -> DataFrame:
    """Join to a lookup table with unique keys.

    The lookup is broadcast when its measured size allows. Otherwise the lookup rows are repeated
    per salt and the left rows spread over the salts, so one hot key is never one task's work; rows
    whose key is null are spread likewise; with one salt, for keys that are never hot, both sides move once. When the caller does not know the answer (`small`), the
    lookup is written once and measured on the way.
    """
    if small is None:
        side, sizes = measured(side, "lookup", **size_measures(side))
        small = is_small(sizes)
    if small:
        return left.join(F.broadcast(side), key, how)
    if salts == 1:
        return left.join(side, key, how)
    spread = [f.name for f in left.schema.fields if f.dataType.typeName() != "map"]
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    salted_side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(salted_side.hint("merge"), [key, "_salt"], how).drop("_salt")
