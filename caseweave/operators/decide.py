"""Escalation gates: five tests, the audit reasons of those that fail, one decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import values as V
from ..functions import text as X


def decide(df: DataFrame, min_confidence: float = V.MIN_CONFIDENCE,
           min_similarity: float = V.MIN_RETRIEVAL_SIMILARITY, allowed_risk: str = V.ALLOWED_RISK,
           has_evidence: str = "has_evidence", has_reply: str = "has_reply") -> DataFrame:
    """Add decision, reason and gate lists. A gate whose input is null is not passed: the message goes to a person.

    Reads intent, confidence, margin, is_ambiguous, risk_level, top_similarity, the flags named by
    `has_evidence` and `has_reply`, and the draft's unsupported_claims_detected and is_grounded.
    """
    c = F.col
    shown = lambda x: F.when(x.isNull(), V.UNKNOWN).otherwise(X.two_decimals(x))
    similarity = F.when(c(has_evidence), c("top_similarity")).otherwise(0.0)

    generic = F.concat(F.lit("Domain risk level ("), F.coalesce(F.upper("risk_level"), F.lit(V.UNKNOWN)),
                       F.lit(") exceeds auto-handle threshold."))
    risk_reason = generic
    for intent, reason in reversed(V.RISK_REASONS.items()):
        risk_reason = F.when(c("intent") == intent, F.lit(reason)).otherwise(risk_reason)
    confidence_reason = F.concat(
        F.lit("Intent confidence ("), shown(c("confidence")),
        F.lit(f") is below the validated safety threshold ({min_confidence:.2f})."))
    margin_reason = F.concat(
        F.lit("Customer query is ambiguous between multiple intents (margin: "), shown(c("margin")),
        F.lit("); human clarification needed."))
    evidence_reason = F.concat(
        F.lit("No sufficiently similar historical resolution was found (top similarity: "),
        shown(similarity), F.lit(f" < threshold: {min_similarity:.2f})."))

    claims = c(has_reply) & c("unsupported_claims_detected")
    ungrounded = c(has_reply) & ~c("unsupported_claims_detected") & ~c("is_grounded")
    # gate, fails when, reason
    gates = [
        (V.GATE_RISK, F.lower("risk_level") != allowed_risk.lower(), risk_reason),
        (V.GATE_CONFIDENCE, c("confidence") < min_confidence, confidence_reason),
        (V.GATE_MARGIN, c("is_ambiguous"), margin_reason),
        (V.GATE_EVIDENCE, ~c(has_evidence) | (c("top_similarity") < min_similarity), evidence_reason),
        (V.GATE_CLAIMS, claims, F.lit(V.CLAIMS_REASON)),
        (V.GATE_GROUNDING, ungrounded, F.lit(V.GROUNDING_REASON)),
    ]
    gates = [(name, F.coalesce(test, F.lit(True)), reason) for name, test, reason in gates]
    failed = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test, _ in gates]))
    reasons = F.array_compact(F.array(*[F.when(test, reason) for _, test, reason in gates]))
    # the fifth gate has two ways to fail and passes under its grounding name
    passed = F.array_compact(F.array(
        *[F.when(~test, F.lit(name)) for name, test, _ in gates[:4]],
        F.when(~gates[4][1] & ~gates[5][1], F.lit(V.GATE_GROUNDING))))
    approval = F.concat(
        F.lit("High confidence ("), shown(c("confidence")), F.lit("), strong historical grounding (sim: "),
        shown(similarity), F.lit("), and low-risk standard troubleshooting."))
    return df.withColumns({"passed_gates": passed, "failed_gates": failed, "_reasons": reasons}).withColumns({
        "is_safe_to_automate": F.size("failed_gates") == 0,
        "decision": F.when(F.size("failed_gates") == 0, V.AUTO).otherwise(V.ESCALATE),
        "reason": F.when(F.size("failed_gates") == 0, approval).otherwise(F.array_join("_reasons", "; ")),
        "confidence_score": c("confidence"),
        "retrieval_score": similarity,
    }).drop("_reasons")
