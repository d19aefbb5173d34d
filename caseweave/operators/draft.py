"""Grounded draft replies taken from the most similar case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import values as V
from ..functions import text as X


def draft_reply(messages: DataFrame, evidence: str = "evidence", min_grounding: float = V.MIN_GROUNDING) -> DataFrame:
    """Reply, evidence ids, summary, grounding score and claim check from the ranked evidence array."""
    found = F.coalesce(F.size(evidence), F.lit(0)) > 0
    top = F.get(F.col(evidence), F.lit(0))
    resolution = F.nullif(X.normalize_edges(top["brand_resolution"]), F.lit(""))
    reply = F.when(found, F.coalesce(resolution, F.lit(V.BLANK_RESOLUTION_REPLY))).otherwise(V.NO_EVIDENCE_REPLY)
    summary = F.when(found, F.concat(
        F.lit("Grounded in case "), top["case_id"], F.lit(" (sim: "), X.two_decimals(top["similarity_score"]),
        F.lit("): '"), F.substring(top["customer_issue"], 1, 60), F.lit("...'"))).otherwise(V.NO_EVIDENCE_SUMMARY)
    score = F.when(found, F.round(top["similarity_score"], 4)).otherwise(0.0)
    drafted = messages.withColumns({
        "reply": reply,
        "evidence_ids": F.coalesce(F.transform(F.slice(evidence, 1, 2), lambda e: e["case_id"]),
                                   F.array().cast("array<string>")),
        "evidence_summary": summary,
        "grounding_score": score,
        "generation_method": F.when(found, V.METHOD_EVIDENCE).otherwise(V.METHOD_FALLBACK),
    })
    claims = (F.col("generation_method") == V.METHOD_EVIDENCE) & unsupported_claims(F.col("reply"))
    return drafted.withColumn("unsupported_claims_detected", claims).withColumn(
        "is_grounded", (F.col("generation_method") == V.METHOD_EVIDENCE) & ~F.col("unsupported_claims_detected")
        & (F.col("grounding_score") >= min_grounding))


def unsupported_claims(reply: Column) -> Column:
    return X.contains_any(F.lower(reply), V.UNSUPPORTED_PHRASES)


def grounding_prompts(messages: DataFrame, message: str, intent: str, evidence: str = "evidence",
                      context: str | None = None) -> DataFrame:
    """The full prompt text per message: question, intent, context and evidence blocks."""
    blocks = F.transform(evidence, lambda e: F.concat(
        F.lit("--- Evidence Case ["), e["case_id"], F.lit("] (Relevance Score: "),
        X.two_decimals(e["similarity_score"]), F.lit(") ---\nCustomer Issue: "), e["customer_issue"],
        F.lit("\nHistorical Support Resolution: "), e["brand_resolution"]))
    found = F.coalesce(F.size(evidence), F.lit(0)) > 0
    known = F.lit(V.PROMPT_NO_CONTEXT) if context is None else F.coalesce(
        F.nullif(F.col(context), F.lit("")), F.lit(V.PROMPT_NO_CONTEXT))
    parts = {
        "message": F.col(message),
        "intent": F.col(intent),
        "context": known,
        "evidence": F.when(found, F.array_join(blocks, "\n\n")).otherwise(V.PROMPT_NO_EVIDENCE),
    }
    pieces, rest = [], V.PROMPT_TEXT
    for name, column in parts.items():
        before, rest = rest.split("{" + name + "}", 1)
        pieces += [F.lit(before), column]
    return messages.withColumn("prompt", F.concat(*pieces, F.lit(rest)))
