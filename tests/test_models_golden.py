import pytest

from caseweave import values as V
from caseweave.operators import classify as C, golden as G, labels as L, leakage as LK, retrieve as R
from caseweave.plans import triage as TR

SENTENCES = [
    ("power is gone after lunch", "battery_power_drain"), ("power bar falls every hour", "battery_power_drain"),
    ("where is the new version", "software_update_os"), ("new version never installs", "software_update_os"),
    ("glass broke in two pieces", "hardware_screen_physical_damage"),
    ("cannot sign in with my name", "apple_id_account_access"),
    ("billed two times this month", "app_store_billing_subscription"),
    ("router link is lost at night", "connectivity_wifi_bluetooth_network"),
    ("music is silent today", "audio_sound_microphone"), ("no space left for photos", "storage_icloud_backup"),
]


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(SENTENCES)], "id long, text string, label string")


@pytest.fixture(scope="module")
def hybrid(sentences):
    return C.fit_hybrid(sentences, "id", "text", "label")


def question(spark, text):
    return spark.createDataFrame([(1, text)], "id long, text string")


def test_majority(spark, sentences):
    (r,) = C.majority_baseline(question(spark, "My phone is broken"), sentences, "label").collect()
    assert (r.intent, r.confidence) == ("battery_power_drain", 0.2)
    assert tuple(C.majority_label(sentences.limit(0), "label").first()) == ("software_update_os", 0.283)


def test_baseline(spark, sentences):
    model = C.fit_baseline(sentences, "id", "text", "label")
    (r,) = C.predict_top2(C.class_scores(question(spark, "battery dies fast"), "id", "text", model)).collect()
    assert r.intent == "battery_power_drain" and 0 <= r.confidence <= 1
    assert abs(sum(s.probability for s in r.scores) - 1) < 1e-9


def test_hybrid(spark, hybrid):
    (r,) = C.predict(question(spark, "where is the new update, the new version"), "id", "text", hybrid, L.taxonomy_dimension(spark)).collect()
    assert r.intent == "software_update_os" and r.confidence > 0
    assert (r.risk_level, r.default_action, r.method) == ("low", V.AUTO, "proposed_hybrid_calibrated")
    assert "update" in r.triggered_keywords and len(r.all_probabilities) == 8


def test_scores_equal_ml_model(spark, sentences, hybrid):
    """The table form gives the training rows their own labels, unknown text the intercepts only."""
    got = C.predict_top2(C.class_scores(sentences, "id", "text", hybrid)).collect()
    assert all(r.intent == r.label for r in got)
    (r,) = C.class_scores(question(spark, "☃"), "id", "text", hybrid).collect()
    import math

    total = sum(math.exp(b) for b in hybrid.intercepts)
    assert {s.intent: round(s.probability, 9) for s in r.scores} == {
        c: round(math.exp(b) / total, 9) for c, b in zip(hybrid.classes, hybrid.intercepts)}


def test_optimality(sentences):
    """The gradient equals one computed from whole vectors; it is small at the fitted coefficients and not beside them."""
    import dataclasses

    import numpy as np

    model = C.fit_baseline(sentences, "id", "text", "label")
    for shift in (0.0, 0.5):
        moved = dataclasses.replace(model, intercepts=[b + shift * (i == 0) for i, b in enumerate(model.intercepts)])
        got = {r.label: r for r in C.optimality(sentences, "id", "text", "label", moved).collect()}
        terms = {r.term: (j, r) for j, r in enumerate(model.terms.collect())}
        labels = [r.label for r in sentences.orderBy("id").collect()]
        x = np.zeros((len(labels), len(terms)))
        (rows,) = C.block_rows(sentences, "id", "text", model.blocks, model.terms, "inner", model.small_terms)
        for r in rows.collect():
            x[r.id, terms[r.term][0]] = r.raw
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        b = np.array([r.coef for _, r in sorted(terms.values(), key=lambda t: t[0])])
        z = np.exp(x @ b + moved.intercepts)
        p, y = z / z.sum(1, keepdims=True), np.array([[c == label for c in model.classes] for label in labels], float)
        w = (len(labels) / (len(model.classes) * y.sum(0)))[y.argmax(1)][:, None]
        slope = np.vstack([x.T @ (w * (p - y)) / w.sum() + model.penalty * b, (w * (p - y)).sum(0) / w.sum()])
        for k, c in enumerate(model.classes):
            assert abs(got[c].gradient - np.abs(slope[:, k]).max()) < 1e-9 and abs(got[c].mass - (w * p)[:, k].sum()) < 1e-9
            assert got[c].documents == labels.count(c)
        assert (max(r.gradient for r in got.values()) < 1e-4) == (shift == 0)


def test_empty_training_and_single_class(spark, sentences):
    with pytest.raises(ValueError):
        C.fit_hybrid(sentences.limit(0), "id", "text", "label")
    model = C.fit_baseline(sentences.filter("label = 'battery_power_drain'"), "id", "text", "label")
    (r,) = C.predict_top2(C.class_scores(question(spark, "hello"), "id", "text", model)).collect()
    assert (r.intent, r.confidence, r.margin, r.is_ambiguous) == ("battery_power_drain", 1.0, 1.0, False)


def test_balanced_weights(spark, sentences):
    got = {r.label: r.weight for r in C.balanced_weights(sentences, "label").collect()}
    assert got["battery_power_drain"] == 10 / (8 * 2) and got["storage_icloud_backup"] == 10 / 8


def test_margin_is_tested_unrounded(spark):
    rows = [(1, [(0.57496, "a"), (0.42504, "b")]), (2, [(0.5, "a"), (0.5, "b")])]
    df = spark.createDataFrame(rows, "id int, scores array<struct<probability:double,intent:string>>")
    a, b = sorted(C.predict_top2(df).collect())
    assert (a.margin, a.is_ambiguous) == (0.1499, True) and (b.intent, b.margin) == ("b", 0.0)


CASES = "case_order long, case_id string, customer_issue string, brand_resolution string, conversation_context string, " \
        "intent string, turn_count long"


def test_triage(spark, hybrid):
    rows = [(1, "mock_001", "lamp power is gone after the new version", "Check Settings > Battery.", "c", "battery_power_drain", 2),
            (2, "mock_002", "sign in with my name fails every day", "Please visit the recovery page.", "c", "apple_id_account_access", 2),
            (3, "mock_003", "the glass broke in the hall", "Check your warranty status.", "c", "hardware_screen_physical_damage", 2)]
    index = R.build_index(spark.createDataFrame(rows, CASES))
    asked = spark.createDataFrame([
        (1, "@AppleSupport lamp power is gone after lunch"),
        (2, "cannot sign in with my name since monday"), (3, "glass broke in two pieces on the floor"),
        (4, "  ")], "id long, text string")
    classifier = TR.model_classifier(hybrid, L.taxonomy_dimension(spark))
    out = {r.id: r for r in TR.triage(asked, "id", "text", index, classifier, "@AppleSupport").collect()}
    assert out[1].predicted_intent in ("battery_power_drain", "software_update_os") and out[1].evidence_ids[0] == "mock_001"
    assert not out[1].cleaned_message.startswith("@")
    assert (out[2].predicted_intent, out[2].risk_level, out[2].decision) == ("apple_id_account_access", "high", V.ESCALATE)
    assert "security" in out[2].escalation_reason
    assert (out[3].predicted_intent, out[3].decision) == ("hardware_screen_physical_damage", V.ESCALATE)
    assert out[4].evidence_ids == [] and V.GATE_EVIDENCE in out[4].failed_gates and out[4].grounding_score == 0.0
    assert len(out[1].asDict()) == 17
    loose = TR.Thresholds(min_confidence=0.0, min_similarity=0.0, min_grounding=0.0, allowed_risk="high")
    again = {r.id: r for r in TR.triage(asked, "id", "text", index, classifier, "@AppleSupport", loose).collect()}
    assert V.GATE_RISK in again[1].failed_gates and V.GATE_RISK not in again[2].failed_gates


def threads(spark):
    words = ["my battery dies fast now ok", "update is odd", "screen", "battery and update together", "hello there friend",
             "wifi wifi", "sound of the speaker", "just saying hi to you"]
    rows = [(i, f"conv_{i}", words[i % len(words)], "answer text here", 2 + i % 4) for i in range(64)]
    return spark.createDataFrame(rows, "root_tweet_id long, conversation_id string, customer_cleaned_issue string, "
                                       "brand_first_response string, turn_count long")


def test_golden_and_leakage(spark):
    pool, dims = threads(spark), L.taxonomy_dimension(spark)
    golden = G.golden_set(pool, dims, 3, 4, 30)
    rows = sorted(golden.collect(), key=lambda r: r.id)
    assert len(rows) == 30 and [r.id for r in rows] == [f"gold_{i:03d}" for i in range(1, 31)]
    assert len({r.conversation_id for r in rows}) == 30
    assert rows == sorted(golden.repartition(7).collect(), key=lambda r: r.id)
    ambiguous = [r for r in rows if r.difficulty == "hard" and r.risk_level == "medium"]
    assert len(ambiguous) == 4 and all("touching both battery_power_drain and software_update_os" in r.gold_reason for r in ambiguous)
    assert sum(r.gold_reason == "General technical advice request." for r in rows) == 30 - 4 - 3 * 4
    assert not any(r.customer_message == "screen" for r in rows)  # one word only
    assert {r.facet: r.percent for r in G.golden_distribution(golden).filter("value = 'AUTO_HANDLE'").collect()}
    assert LK.duplicate_ids(golden).first().duplicates == 0
    assert LK.unregistered_ids(golden, golden.limit(29).select("conversation_id")).count() == 1
    assert LK.text_overlap(pool, "conversation_id", "customer_cleaned_issue", golden, "customer_message").count() > 30
    bad = spark.createDataFrame([("g", "tell me gold_decision"), ("h", "fine")], "id string, customer_message string")
    assert [r.id for r in LK.label_in_input(bad).collect()] == ["g"]
    cases = R.build_cases(pool, golden, V.GOLDEN_KEYWORDS)
    assert LK.id_overlap(golden, cases).count() == 0 and cases.count() > 0


def test_difficulty(spark):
    df = spark.createDataFrame([(5, 2, "hard"), (6, 3, "easy"), (26, 2, "medium"), (25, 4, "medium"), (3, 9, "hard")],
                               "w int, t int, want string")
    from pyspark.sql import functions as F

    assert all(r.got == r.want for r in df.withColumn("got", G.difficulty(F.col("w"), F.col("t"))).collect())
