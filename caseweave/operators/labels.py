"""Weak labels: whole-word keyword predicates turned into intents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schemas, values as V
from ..functions import keywords as K
from ..functions import text as X


def taxonomy_dimension(spark: SparkSession, taxonomy=None) -> DataFrame:
    """The intent taxonomy as a table with its order."""
    rows = [(i, *row, None, [], []) for i, row in enumerate(V.TAXONOMY if taxonomy is None else taxonomy, start=1)]
    return spark.createDataFrame(rows, schemas.TAXONOMY)


def label_first_match(df: DataFrame, text: str, dictionary=V.CORE_KEYWORDS,
                      default: str = V.DEFAULT_INTENT) -> DataFrame:
    return df.withColumn("intent", K.first_match(F.col(text), dictionary, default))


def label_all_matches(df: DataFrame, text: str, dictionary=V.GOLDEN_KEYWORDS) -> DataFrame:
    return df.withColumn("intents", K.all_matches(F.col(text), dictionary))


def label_single_match(df: DataFrame, text: str, dictionary=V.CORE_KEYWORDS) -> DataFrame:
    """Label only texts that match exactly one intent; drop the others."""
    return (label_all_matches(df, text, dictionary).filter(F.size("intents") == 1)
            .withColumn("intent", F.col("intents")[0]).drop("intents"))


def multi_label_pessimistic(df: DataFrame, text: str, taxonomy: DataFrame, dictionary=V.GOLDEN_KEYWORDS) -> DataFrame:
    """All matching intents; one high-risk intent among them sends the message to a person, and so does none at all.

    Adds intents, high_risk_intents, risk_level (the highest of the matches, medium without a match) and decision.
    """
    rank = {"low": 1, "medium": 2, "high": 3}
    rows = {r["name"]: (r["risk_level"] or "medium").lower() for r in taxonomy.select("name", "risk_level").collect()}  # one per intent
    names = {level: [n for n, r in rows.items() if r == level] for level in rank}
    listed = lambda level: F.array(*[F.lit(n) for n in names[level]]).cast("array<string>")
    out = label_all_matches(df, text, dictionary).withColumn("high_risk_intents", F.array_intersect("intents", listed("high")))
    low_only = (F.size("intents") > 0) & (F.size(F.array_except("intents", listed("low"))) == 0)
    level = F.when(F.size("high_risk_intents") > 0, "high").when(low_only, "low").otherwise("medium")
    return out.withColumn("risk_level", level).withColumn("decision", F.when(level == "low", V.AUTO).otherwise(V.ESCALATE))


def min_words(df: DataFrame, text: str, n: int = 3) -> DataFrame:
    return df.filter(X.word_count(F.col(text)) >= n)


def drop_acknowledgements(df: DataFrame, text: str) -> DataFrame:
    return df.filter(~F.lower(text).isin(V.ACKNOWLEDGEMENTS))


def intent_frequency(df: DataFrame, text: str, dictionary=V.DISCOVERY_KEYWORDS, taxonomy=None) -> DataFrame:
    """Count and share per first-match intent; intents without a match stay with 0."""
    spark = df.sparkSession
    labelled = label_first_match(df, text, dictionary, V.UNCLASSIFIED)
    counts = labelled.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))
    risks = {row[0]: row[2] for row in (V.TAXONOMY if taxonomy is None else taxonomy)}
    names = [(i, name, risks.get(name)) for i, (name, _) in enumerate(dictionary, start=1)]
    names.append((len(names) + 1, V.UNCLASSIFIED, None))
    order = spark.createDataFrame(names, "priority int, intent string, risk_level string")
    total = F.sum("n").over(Window.partitionBy())  # one row per intent
    return (F.broadcast(order).join(counts, "intent", "left")
            .select("priority", "intent", "risk_level", F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce(F.round(F.col("n") / total * 100, 1), F.lit(0.0)).alias("percent")))


def intent_samples(df: DataFrame, text: str, order: str, k: int = 5, dictionary=V.DISCOVERY_KEYWORDS) -> DataFrame:
    """The first k texts of every matched intent."""
    labelled = label_first_match(df, text, dictionary, V.UNCLASSIFIED).filter(F.col("intent") != V.UNCLASSIFIED)
    place = F.row_number().over(Window.partitionBy("intent").orderBy(order))
    return labelled.withColumn("sample_no", place).filter(F.col("sample_no") <= k)


def training_sample(threads: DataFrame, held_out: DataFrame, n: int | None = V.MAX_TRAINING_ROWS,
                    dictionary=V.CORE_KEYWORDS, order: str = "root_tweet_id",
                    text: str = "customer_cleaned_issue") -> DataFrame:
    """The first n single-match texts, in thread order, of conversations that are not held out."""
    pool = threads.join(held_out.select("conversation_id").distinct(), "conversation_id", "left_anti")
    eligible = label_single_match(min_words(pool, text), text, dictionary)
    return eligible if n is None else eligible.orderBy(order).limit(n)


def taxonomy_join(df: DataFrame, taxonomy: DataFrame, intent: str = "intent") -> DataFrame:
    """Add risk level and default action; an unknown intent is medium risk and goes to a person."""
    side = F.broadcast(taxonomy.select(F.col("name").alias(intent), "risk_level", "default_action"))
    return (df.join(side, intent, "left")
            .withColumn("risk_level", F.coalesce("risk_level", F.lit("medium")))
            .withColumn("default_action", F.coalesce("default_action", F.lit(V.ESCALATE))))


def multi_keyword_hits(c: Column, dictionary) -> list[Column]:
    """Per intent, how many of its keywords occur in the text."""
    return [sum((K.has_keyword(c, [w]).cast("int") for w in ws), F.lit(0)).alias(i) for i, ws in dictionary]
