import itertools

import pytest

from caseweave import values as V
from caseweave.operators.decide import decide

SCHEMA = ("id int, intent string, confidence double, margin double, is_ambiguous boolean, risk_level string, "
          "has_evidence boolean, top_similarity double, has_reply boolean, unsupported_claims_detected boolean, "
          "is_grounded boolean")


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    return sorted(decide(df, **options).collect(), key=lambda r: r.id)


def test_every_combination(spark):
    rows = list(itertools.product(["battery_power_drain"], [0.92, 0.45], [0.1], [False, True], ["low", "high"],
                                  [True, False], [0.75, 0.15], [True, False], [False, True], [True, False]))
    for row, got in zip(rows, run(spark, rows)):
        _, confidence, _, ambiguous, risk, evidence, similarity, reply, claims, grounded = row
        failed = []
        if risk != "low":
            failed.append(V.GATE_RISK)
        if confidence < 0.60:
            failed.append(V.GATE_CONFIDENCE)
        if ambiguous:
            failed.append(V.GATE_MARGIN)
        if not evidence or similarity < 0.30:
            failed.append(V.GATE_EVIDENCE)
        if reply and claims:
            failed.append(V.GATE_CLAIMS)
        elif reply and not grounded:
            failed.append(V.GATE_GROUNDING)
        assert got.failed_gates == failed
        assert len(got.passed_gates) + len(got.failed_gates) == 5
        assert got.decision == (V.ESCALATE if failed else V.AUTO) and got.is_safe_to_automate == (not failed)
        assert failed == [] or got.reason.count("; human clarification") == ambiguous
        assert got.retrieval_score == (similarity if evidence else 0.0)


def test_thresholds_are_inclusive(spark):
    base = ("battery_power_drain", 0.60, 0.15, False, "LOW", True, 0.30, True, False, True)
    (ok,) = run(spark, [base])
    assert ok.decision == V.AUTO
    assert ok.reason == ("High confidence (0.60), strong historical grounding (sim: 0.30), and low-risk standard "
                         "troubleshooting.")
    below = [(*base[:1], 0.5999, *base[2:]), (*base[:6], 0.2999, *base[7:])]
    assert [r.failed_gates for r in run(spark, below)] == [[V.GATE_CONFIDENCE], [V.GATE_EVIDENCE]]
    assert [r.decision for r in run(spark, below, min_confidence=0.5, min_similarity=0.2)] == [V.AUTO, V.AUTO]


def test_missing_values_go_to_a_person(spark):
    base = ("battery_power_drain", 0.90, 0.15, False, "low", True, 0.50, True, False, True)
    gates = {1: V.GATE_CONFIDENCE, 3: V.GATE_MARGIN, 4: V.GATE_RISK, 5: V.GATE_EVIDENCE, 6: V.GATE_EVIDENCE}
    for place, gate in gates.items():
        (got,) = run(spark, [(*base[:place], None, *base[place + 1:])])
        assert got.decision == V.ESCALATE and got.failed_gates == [gate] and gate not in got.passed_gates
        assert "nu)" not in got.reason and "null" not in got.reason
    (got,) = run(spark, [(*base[:8], None, None)])
    assert got.decision == V.ESCALATE and V.GATE_GROUNDING not in got.passed_gates


@pytest.mark.parametrize("intent,part", [
    ("apple_id_account_access", "security-sensitive"), ("app_store_billing_subscription", "billing authorization"),
    ("hardware_screen_physical_damage", "physical hardware damage"), ("other", "Domain risk level (MEDIUM) exceeds")])
def test_risk_reasons(spark, intent, part):
    (r,) = run(spark, [(intent, 0.95, 0.5, False, "medium", True, 0.8, False, None, None)])
    assert r.decision == V.ESCALATE and part in r.reason and r.failed_gates == [V.GATE_RISK]


def test_reason_texts(spark):
    (r,) = run(spark, [("x", 0.455, 0.104, True, "low", False, 0.15, True, False, False)])
    assert r.reason == (
        "Intent confidence (0.46) is below the validated safety threshold (0.60).; Customer query is ambiguous between "
        "multiple intents (margin: 0.10); human clarification needed.; No sufficiently similar historical resolution was "
        "found (top similarity: 0.00 < threshold: 0.30).; Generated reply is insufficiently grounded in verified "
        "historical evidence.")
