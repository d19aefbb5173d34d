"""Readers and writers: message CSV, threads, held-out ids, evaluation sets, result records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from .csvranges import read_csv_ranges


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of the message CSV: header, quoted texts that may hold line breaks.

    Each file is one task here; `read_tweets_ranges` reads a large file in many. Convert once with `write_tweets` and work on
    the Parquet form.
    """
    return (spark.read.schema(schemas.TWEETS).option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"').csv(path))


def read_tweets_ranges(spark: SparkSession, path: str) -> DataFrame:
    """`read_tweets` for large files: in byte ranges, as many tasks as the files have ranges."""
    return read_csv_ranges(spark, path, schemas.TWEETS)


def write_tweets(tweets: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet by default, in id order inside each file; 'csv' writes the exchange form, in id order."""
    if fmt == "csv":
        tweets.orderBy("tweet_id").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        tweets.sortWithinPartitions("tweet_id").write.mode("overwrite").format(fmt).save(path)


def read_threads(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.THREADS).format(fmt).load(path)


def write_threads(nested: DataFrame, path: str, fmt: str = "json") -> None:
    nested.write.mode("overwrite").format(fmt).save(path)


def read_held_out(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of conversation ids, over any lines, or JSON lines with a conversation_id field. Read by line, so
    a long list is split."""
    line = F.trim("value")
    quoted = F.regexp_extract_all(line, F.lit(r'"(?:[^"\\\\]|\\\\.)*"'), F.lit(0))
    of_array = F.transform(quoted, lambda x: F.get_json_object(F.concat(F.lit('{"v":'), x, F.lit("}")), "$.v"))
    of_line = F.array(F.get_json_object(line, "$.conversation_id"))
    ids = spark.read.text(path).select(F.explode(F.when(line.startswith("{"), of_line).otherwise(of_array)).alias("conversation_id"))
    return ids.filter(F.col("conversation_id").isNotNull()).distinct()


def write_held_out(golden: DataFrame, path: str) -> None:
    golden.select("conversation_id").distinct().write.mode("overwrite").json(path)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLDEN).json(path)


def write_golden(golden: DataFrame, path: str) -> None:
    golden.write.mode("overwrite").json(path)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Intents from a JSON file, or a YAML file where the yaml module is installed; Spark reads either.

    Both hold {"intents": [{name, display_name, description, risk_level, default_action, examples, resolution_patterns,
    escalation_conditions}, ...]}.
    """
    texts = "examples", "resolution_patterns", "escalation_conditions"
    item = "name:string,display_name:string,risk_level:string,default_action:string,description:string," + ",".join(
        f"{t}:array<string>" for t in texts)
    raw = spark.read.text(path, wholetext=True)
    if path.endswith((".yaml", ".yml")):
        import json

        import yaml

        parsed = [(json.dumps(yaml.safe_load(r["value"])),) for r in raw.collect()]  # one small file
        raw = spark.createDataFrame(parsed, "value string")
    parsed = raw.select(F.from_json("value", f"intents array<struct<{item}>>").alias("doc"))
    return parsed.select(F.posexplode("doc.intents").alias("pos", "i")).select(
        (F.col("pos") + 1).alias("priority"), "i.name", "i.display_name",
        F.coalesce("i.risk_level", F.lit("low")).alias("risk_level"),
        F.coalesce("i.default_action", F.lit("AUTO_HANDLE")).alias("default_action"),
        *[F.coalesce(f"i.{t}", F.array().cast("array<string>")).alias(t) for t in texts[:1]], "i.description",
        *[F.coalesce(f"i.{t}", F.array().cast("array<string>")).alias(t) for t in texts[1:]])


def write_record(record: DataFrame, path: str) -> None:
    """A one-row result record as a single JSON document."""
    record.coalesce(1).write.mode("overwrite").json(path)
