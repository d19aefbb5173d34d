"""Evaluation aggregates: classification, retrieval, escalation safety."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import values as V
from ..session import materialize


def _share(top: Column, bottom: Column) -> Column:
    """top / bottom, with 0 for an empty denominator."""
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def accuracy(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.round(F.avg((F.col(truth) == F.col(predicted)).cast("double")), 4).alias("accuracy"))


def class_counts(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """(label, hits, support, predicted) for every label that is true or predicted somewhere."""
    by = by or []
    hit = (F.col(truth) == F.col(predicted)).cast("long")
    sides = F.array(F.struct(F.col(truth).alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p"), hit.alias("h")),
                    F.struct(F.col(predicted).alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                             F.lit(0).cast("long").alias("h")))
    return (df.select(*by, F.explode(sides).alias("s")).groupBy(*by, F.col("s.label").alias("label"))
            .agg(F.sum("s.h").alias("hits"), F.sum("s.t").alias("support"), F.sum("s.p").alias("predicted")))


def _prf(counts: DataFrame) -> DataFrame:
    h, t, p = (F.col(c).cast("double") for c in ("hits", "support", "predicted"))
    return counts.withColumns({"precision": _share(h, p), "recall": _share(h, t), "f1": _share(2 * h, t + p)})


def per_class_prf(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    return _prf(class_counts(df, truth, predicted, by)).select(
        *(by or []), "label", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], "support")


def macro_prf(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """Unweighted means over the labels."""
    return _prf(class_counts(df, truth, predicted, by)).groupBy(*(by or [])).agg(
        *[F.round(F.avg(c), 4).alias(f"macro_{c}") for c in ("precision", "recall", "f1")])


def confusion_matrix(df: DataFrame, truth: str, predicted: str, max_labels: int = 2_000) -> DataFrame:
    """Long form (truth, predicted, n) over all label pairs, zeros included.

    Every label contributes one zero row per other label; the labels are first reduced to one list. More than
    `max_labels` labels are an error, not a cut: the matrix has a row for each pair.
    """
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "labelpairs")
    every = counts.select(F.explode(F.array("truth", "predicted")).alias("label"))
    if every.distinct().limit(max_labels + 1).count() > max_labels:
        raise ValueError(f"a matrix of more than {max_labels} labels")
    labels = every.agg(
        F.collect_set("label").alias("labels"))
    grid = labels.select(F.explode("labels").alias("truth"), "labels").select(
        "truth", F.explode("labels").alias("predicted"), F.lit(0).cast("long").alias("n"))
    return counts.unionByName(grid).groupBy("truth", "predicted").agg(F.sum("n").alias("n"))


def model_comparison(df: DataFrame, truth: str, predicted: str, system: str = "system") -> DataFrame:
    """Accuracy and macro averages of several systems over stacked predictions, from one pass."""
    return _prf(class_counts(df, truth, predicted, [system])).groupBy(system).agg(
        F.round(F.sum("hits") / F.sum("support"), 4).alias("accuracy"),
        *[F.round(F.avg(c), 4).alias(f"macro_{c}") for c in ("precision", "recall", "f1")])


def first_relevant(queries: DataFrame, results: DataFrame, query_id: str, gold: str,
                   similarity: float = V.RELEVANT_SIMILARITY) -> DataFrame:
    """Per query, the first rank whose case has the gold intent or a high similarity, or null.

    `results` carries the gold label of its query, so no join back is needed for the test.
    """
    relevant = (F.col("case_intent") == F.col(gold)) | (F.col("similarity_score") >= similarity)
    per_query = results.groupBy(query_id).agg(
        F.min(F.when(relevant, F.col("rank"))).alias("first_rank"),
        F.max(F.when(F.col("rank") == 1, F.col("similarity_score"))).alias("top1"))
    return queries.select(query_id).join(per_query, query_id, "left")


def retrieval_metrics(first: DataFrame) -> DataFrame:
    """Recall at 1, 3 and 5, mean reciprocal rank and mean top similarity over all queries."""
    def recall(k: int) -> Column:
        return F.coalesce(F.round(F.avg(F.coalesce((F.col("first_rank") <= k).cast("double"), F.lit(0.0))), 4),
                          F.lit(0.0))
    return first.agg(
        recall(1).alias("recall_at_1"), recall(3).alias("recall_at_3"), recall(5).alias("recall_at_5"),
        F.coalesce(F.round(F.avg(F.coalesce(1.0 / F.col("first_rank"), F.lit(0.0))), 4), F.lit(0.0)).alias("mrr"),
        F.round(F.avg("top1"), 4).alias("mean_top1_similarity"))


def escalation_safety(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Coverage, precision and error rates of automation; no row for no input."""
    t, p = F.col(truth), F.col(predicted)
    auto, esc = F.lit(V.AUTO), F.lit(V.ESCALATE)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_eval_cases"),
        F.count_if(p == auto).alias("auto_pred"), F.count_if(t == esc).alias("escalate_true"),
        F.count_if((t == auto) & (p == auto)).alias("correct_auto_handles"),
        F.count_if((t == esc) & (p == auto)).alias("false_auto_handles"),
        F.count_if((t == esc) & (p == esc)).alias("correct_escalations"),
        F.count_if((t == auto) & (p == esc)).alias("unnecessary_escalations"))
    c = F.col
    return counts.filter(c("total_eval_cases") > 0).select(
        F.round(c("auto_pred") / c("total_eval_cases"), 4).alias("automation_coverage"),
        F.round(_share(c("correct_auto_handles"), c("auto_pred")), 4).alias("auto_handle_precision"),
        F.round(_share(c("false_auto_handles"), c("auto_pred")), 4).alias("false_auto_rate"),
        F.round(_share(c("correct_escalations"), c("escalate_true")), 4).alias("escalation_recall"),
        "correct_auto_handles", "false_auto_handles", "correct_escalations", "unnecessary_escalations",
        "total_eval_cases")


def escalation_windows(rows: DataFrame, at: str, escalated: str, width: str = "1 hour", delay: str | None = None) -> DataFrame:
    """(window_start, window_end, n, n_escalated, escalation_rate) of tumbling event-time windows; for batch and streams.

    On a stream, `delay` is the watermark: rows later than it are dropped and a window is final once it has passed.
    Rows without a time drop out; a null flag counts as escalated, as the gates do.
    """
    rows = rows.select(at, F.coalesce(escalated, F.lit(True)).alias("_hit"))
    rows = rows.withWatermark(at, delay) if delay else rows
    counts = rows.groupBy(F.window(at, width).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if("_hit").alias("n_escalated"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "n_escalated",
                         F.round(F.col("n_escalated") / F.col("n"), 4).alias("escalation_rate"))
