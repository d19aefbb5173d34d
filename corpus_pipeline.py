"""Documents to packed training sequences, in stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseweave.llm import hostrules, mixing, omh, packing, secrets
from caseweave.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose host is rejected, go. Null or empty texts fail; repeated rows stand and fall together; extra
    columns stay; an empty table gives one."""
    return hostrules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest doc_id. Rows without a doc_id stay; null and empty
    texts are one class; different texts under one doc_id are documents of their own; extra columns stay; an empty table gives one."""
    return omh.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark. Null and empty texts stay as they are, long ones are searched whole, repeated rows change
    alike; extra columns stay; an empty table gives one."""
    return secrets.redact(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to twice, towards an even mix; every document stays at least once. The rows are written in the
    mix's order. A null source is the one with the empty name, a null or empty text counts one token, repeated rows are kept
    together; extra columns stay; an empty table gives one."""
    return mixing.in_order(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048. A null or empty text is its closing id alone, a long one takes many sequences, repeated rows
    are packed each; other columns are dropped; an empty table gives none."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("near-dedup", near_dedup), ("secret scans", secret_scans),
          ("mixing", mixing_weights), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
