"""The benchmark: three systems and all metrics on an evaluation set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import classify, failures, judge, metrics
from ..session import materialize
from . import triage as T


def retrieval_rows(outputs: DataFrame, key: str = "id") -> DataFrame:
    """The nested evidence of triage outputs as (query, rank, similarity, case intent, gold intent)."""
    return outputs.select(key, "gold_intent", F.explode("historical_evidence").alias("e")).select(
        key, "gold_intent", F.col("e.rank").alias("rank"), F.col("e.similarity_score").alias("similarity_score"),
        F.col("e.intent").alias("case_intent"))


def golden_outputs(golden: DataFrame, index, classifier: T.Classifier, handle: str,
                   limits: T.Thresholds = T.Thresholds()) -> DataFrame:
    """Triage outputs of every evaluation message next to its gold labels."""
    outputs = T.triage(golden.select("id", "customer_message"), "id", "customer_message", index, classifier, handle,
                       limits).drop("risk_level", "customer_message")
    return golden.join(outputs, "id")


def stacked_predictions(outputs: DataFrame, baseline: classify.LinearModel | None) -> DataFrame:
    """(system, id, gold_intent, predicted_intent) for the systems under comparison."""
    rows = outputs.select(F.lit("proposed_system").alias("system"), "id", "gold_intent", "predicted_intent")
    majority = classify.majority_baseline(outputs.select("id", "gold_intent"), outputs, "gold_intent")
    rows = rows.unionByName(majority.select(
        F.lit("majority_baseline").alias("system"), "id", "gold_intent", F.col("intent").alias("predicted_intent")))
    if baseline is not None:
        scored = classify.predict_top2(classify.class_scores(
            outputs.select("id", "gold_intent", "customer_message"), "id", "customer_message", baseline))
        rows = rows.unionByName(scored.select(
            F.lit("tfidf_baseline").alias("system"), "id", "gold_intent", F.col("intent").alias("predicted_intent")))
    return rows


def judged(outputs: DataFrame) -> DataFrame:
    top = F.coalesce(F.get(F.col("historical_evidence"), F.lit(0))["similarity_score"], F.lit(0.0))
    return judge.judge_scores(outputs.withColumn("top_similarity", top), "customer_message", "draft_reply")


def evaluate(golden: DataFrame, index, classifier: T.Classifier, handle: str,
             baseline: classify.LinearModel | None = None, limits: T.Thresholds = T.Thresholds(),
             ratings: DataFrame | None = None) -> DataFrame:
    """One nested row with all results. The triage outputs are written once and read by every metric.

    `ratings` holds two raters' (human_score, human_verdict, overall_score, verdict); without it there is no agreement.
    """
    outputs = materialize(golden_outputs(golden, index, classifier, handle, limits), "outputs")
    systems = metrics.model_comparison(stacked_predictions(outputs, baseline), "gold_intent", "predicted_intent")
    per_class = metrics.per_class_prf(outputs, "gold_intent", "predicted_intent")
    matrix = metrics.confusion_matrix(outputs, "gold_intent", "predicted_intent")
    first = metrics.first_relevant(outputs, retrieval_rows(outputs), "id", "gold_intent")
    scores = judged(outputs)

    def rows(df: DataFrame):
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns)))).scalar()  # one row per class or system

    def one(df: DataFrame):
        return df.select(F.struct(*df.columns)).scalar()

    parts = {
        "golden_set_size": outputs.agg(F.count(F.lit(1))).scalar(),
        "comparative_classification_results": rows(systems),
        "per_intent_metrics": rows(per_class),
        "confusion_matrix": rows(matrix),
        "retrieval_evaluation": one(metrics.retrieval_metrics(first)),
        "escalation_safety_evaluation": one(metrics.escalation_safety(outputs, "gold_decision", "decision")),
        "judge_evaluation": one(judge.judge_summary(scores)),
        **({} if ratings is None else {"rater_agreement_evaluation": one(judge.rater_agreement(ratings))}),
        "failure_modes": rows(failures.failure_modes(outputs.drop("risk_level"))),
    }
    return golden.sparkSession.range(1).select(*[c.alias(n) for n, c in parts.items()])
