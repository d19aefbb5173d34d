"""Failure analysis: the first evaluated message of each of five failure modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import values as V
from ..functions import text as X


def failure_modes(records: DataFrame, order: str = "id", boundary_intents=None, symptom: str = "screen",
                  symptom_signs=("black", "line"), joiner: str = "and") -> DataFrame:
    """One row per mode that occurs.

    Reads customer_message, gold_intent, predicted_intent, gold_decision, decision,
    grounding_score and is_ambiguous.
    """
    text, words = F.lower("customer_message"), X.word_count(F.col("customer_message"))
    c = F.col
    tests = {
        1: (c("gold_intent") != c("predicted_intent")) & (text.contains(joiner) | (words > 15)),
        2: (words <= 4) & (c("gold_decision") == V.AUTO) & (c("decision") == V.ESCALATE),
        3: text.contains(symptom) & X.contains_any(text, list(symptom_signs)),
        4: (c("grounding_score") < 0.50) & (c("gold_decision") == V.AUTO),
        5: c("gold_intent").isin(list(boundary_intents or V.BOUNDARY_INTENTS)) & c("is_ambiguous"),
    }
    modes = F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in tests.items()]))
    record = F.struct(
        c("customer_message").alias("real_example"), c("gold_intent").alias("expected_intent"),
        c("predicted_intent").alias("actual_intent"), c("gold_decision").alias("expected_decision"),
        c("decision").alias("actual_decision"))
    first = (records.select(order, record.alias("record"), F.explode(modes).alias("mode"))
             .groupBy("mode").agg(F.min_by("record", order).alias("record")))
    names = records.sparkSession.createDataFrame(V.FAILURE_MODES, "mode int, failure_mode string")
    return first.join(F.broadcast(names), "mode").select("mode", "failure_mode", "record.*")
