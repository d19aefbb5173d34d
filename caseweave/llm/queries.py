"""The operators over the given tables, by name, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, crosspoly, hostrules, merkle, mixing, omh, oracle, packing, permuterm, rff, secrets, topk, toxicity, unigram
from .common import fold_of, table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.judge(table(spark, sf_dir, "documents")).drop("failed_rules").withColumn("host_rate", F.round("host_rate", 6))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rff.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold_of("doc_id", 4) == 2)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(given.unionByName(added)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold_of("doc_id", 5) == 0)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.classes(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "_mix.tokens", "_mix.epoch", "_mix.block", "_mix.block_turn", "_mix.turn")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.variants(permuterm.word_counts(table(spark, sf_dir, "documents"), slips=199))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspoly.search(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0]))) | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_topk": oracle.topk(), "op3_quality_rules": oracle.quality_rules(), "op10_mixing": oracle.mixing(),
            "op11_merkle_manifest": oracle.merkle(), "op12_spelling_variants": oracle.spelling()}
