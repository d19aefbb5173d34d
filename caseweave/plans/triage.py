"""The flagship job: clean, classify, retrieve, draft and decide for a table of messages."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, functions as F

from .. import values as V
from ..functions import text as X
from ..operators import classify, draft, retrieve
from ..operators.decide import decide

# A classifier turns (messages, id column, text column) into the same rows plus intent, confidence,
# margin, is_ambiguous, risk_level and default_action.
Classifier = Callable[[DataFrame, str, str], DataFrame]


@dataclass(frozen=True)
class Thresholds:
    min_confidence: float = V.MIN_CONFIDENCE
    min_similarity: float = V.MIN_RETRIEVAL_SIMILARITY
    min_grounding: float = V.MIN_GROUNDING
    allowed_risk: str = V.ALLOWED_RISK
    margin: float = V.AMBIGUITY_MARGIN
    top_k: int = 3
    search_floor: float = 0.0


def model_classifier(model: classify.LinearModel, taxonomy: DataFrame,
                     margin: float = V.AMBIGUITY_MARGIN) -> Classifier:
    return lambda df, doc, text: classify.predict(df, doc, text, model, taxonomy, margin)


def evidence(messages: DataFrame, index: retrieve.CaseIndex, key: str, text: str, k: int = 3,
             floor: float = 0.0) -> DataFrame:
    """(key, evidence): the ranked cases of every message that has any."""
    found = retrieve.search_topk(messages.select(key, text), index, key, text, k, None, floor)
    return retrieve.evidence_array(found, key)


def add_evidence(messages: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Add `evidence` (array, null when there is none), `has_evidence` and `top_similarity`."""
    return messages.join(found, key, "left").withColumns({
        "has_evidence": F.coalesce(F.size("evidence"), F.lit(0)) > 0,
        "top_similarity": F.coalesce(F.get(F.col("evidence"), F.lit(0))["similarity_score"], F.lit(0.0)),
    })


def triage(messages: DataFrame, key: str, text: str, index: retrieve.CaseIndex, classifier: Classifier, handle: str,
           limits: Thresholds = Thresholds()) -> DataFrame:
    """One output row per message: prediction, evidence, draft, decision and audit trail."""
    cleaned = messages.select(key, F.col(text).alias("customer_message"),
                              X.clean_customer_text(F.col(text), handle).alias("cleaned_message"))
    predicted = classifier(cleaned, key, "cleaned_message")
    # searched from the cleaned text, so that the classifier runs once
    found = evidence(cleaned, index, key, "cleaned_message", limits.top_k, limits.search_floor)
    searched = add_evidence(predicted, found, key)
    drafted = draft.draft_reply(searched, min_grounding=limits.min_grounding).withColumn("has_reply", F.lit(True))
    decided = decide(drafted, limits.min_confidence, limits.min_similarity, limits.allowed_risk)
    return decided.select(
        key, "customer_message", "cleaned_message", F.col("intent").alias("predicted_intent"),
        F.col("confidence").alias("intent_confidence"), F.col("margin").alias("intent_margin"), "is_ambiguous",
        "risk_level", F.col("evidence").alias("historical_evidence"), F.col("reply").alias("draft_reply"),
        "evidence_ids", "grounding_score", "decision", F.col("reason").alias("escalation_reason"),
        "is_safe_to_automate", "passed_gates", "failed_gates")
