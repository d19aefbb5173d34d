import pytest

from caseweave import values as V
from caseweave.operators import classify as C
from caseweave.plans import bindings as T, registry as Q

SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One conversation for each of 40 questions that hold a keyword of one intent."""
    asked = [f"please tell me about {w} number {n} today" for n in range(4) for w in ("thor", "que", "pour", "nicht", "und", "des", "thou", "erin", "die", "der")]
    rows = [(i, turn, role, text) for i, q in enumerate(asked) for turn, role, text in ((0, "user", q), (1, "assistant", f"here is an answer to question {i}"))]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(path / "conversations.parquet"))
    yield str(path)
    T.forget()


def test_hybrid_learns_from_all_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(V, "MAX_TRAINING_ROWS", 12)
    monkeypatch.setattr(V, "MAX_BASELINE_ROWS", 11)
    T.forget()
    learnt = []
    for name in ("fit_hybrid", "fit_baseline"):
        def fit(docs, *more, real=getattr(C, name)):
            learnt.append(docs.count())
            return real(docs, *more)
        monkeypatch.setattr(C, name, fit)
    every = T.training_rows(spark, folder, None).count()
    assert every > 12
    assert Q.hybrid_classifier(spark, folder).count() == 40 and learnt == [every]
    assert {r["optimal"] for r in Q.hybrid_classifier_certificate(spark, folder).collect()} == {True}  # of the rows that its SQL twin counts
    assert sum(r["documents"] for r in Q.hybrid_classifier_certificate(spark, folder).collect()) == 12 and learnt == [every, 12]
    Q.tfidf_baseline(spark, folder).count()
    assert learnt == [every, 12, 11]


def test_model_of_all_rows_is_optimal(spark, folder):
    rows = T.training_rows(spark, folder, None)
    found = C.optimality(rows, "tweet_id", "cleaned_text", "intent", Q._fitted(spark, folder, "hybrid")).collect()
    assert sum(r["documents"] for r in found) == rows.count() and max(r["gradient"] for r in found) < 1e-4
