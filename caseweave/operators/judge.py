"""Rubric scores for drafted replies, and agreement between two raters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import values as V
from ..functions import text as X
from ..session import lookup_join, materialize
from .golden import draw_order

AXES = ["correctness", "groundedness", "helpfulness", "unsupported_claims", "tone"]


def judge_scores(df: DataFrame, message: str = "customer_message", reply: str = "reply",
                 similarity: str = "top_similarity") -> DataFrame:
    """Five axes, the overall mean, verdict and feedback. A blank reply gets 1.0 everywhere."""
    r, m = F.lower(reply), F.lower(message)
    sim = F.coalesce(F.col(similarity), F.lit(0.0))
    polite = sum((F.coalesce(r.contains(w), F.lit(False)).cast("int") for w in V.JUDGE_POLITE), F.lit(0))
    shared = F.lit(False)
    for w in V.JUDGE_DOMAIN:
        shared = shared | (m.contains(w) & r.contains(w))
    shared = F.coalesce(shared, F.lit(False))
    blank = X.is_blank(F.col(reply))
    axis = {
        "unsupported_claims": F.when(X.contains_any(r, V.JUDGE_CLAIMS), 1.0).otherwise(5.0),
        "groundedness": F.when(sim >= 0.70, 5.0).when(sim >= 0.55, 4.0).when(sim >= 0.40, 3.0).otherwise(2.0),
        "tone": F.least(F.lit(5.0), F.lit(3.0) + F.lit(0.5) * polite),
        "helpfulness": F.when(X.contains_any(r, V.JUDGE_ACTIONS), 4.5).when(
            X.contains_any(r, V.JUDGE_DIRECT), 4.0).otherwise(3.0),
        "correctness": F.when(shared | (sim >= 0.50), 4.5).otherwise(3.5),
    }
    scored = df.withColumns({name: F.when(blank, 1.0).otherwise(score) for name, score in axis.items()})
    overall = sum((F.col(a) for a in AXES), F.lit(0.0)) / 5.0
    feedback = F.concat(F.lit("Grounded in evidence (sim: "), X.two_decimals(sim), F.lit("). Tone: "),
                        F.format_string("%.1f", "tone"), F.lit("/5. No unauthorized promises."))
    return scored.withColumns({
        "verdict": F.when((overall >= 3.5) & (F.col("unsupported_claims") >= 4.0), "PASS").otherwise("FAIL"),
        "overall_score": F.round(overall, 2),
        "feedback": F.when(blank, "Empty or missing response.").otherwise(feedback),
    })


def judge_summary(scores: DataFrame) -> DataFrame:
    means = [F.round(F.avg(a), 2).alias(f"mean_{a}") for a in AXES + ["overall_score"]]
    return scores.agg(*means, F.round(F.avg((F.col("verdict") == "PASS").cast("double")) * 100, 2).alias("pass_rate"),
                      F.count(F.lit(1)).alias("total_evaluated"))


def agreement_sample(scores: DataFrame, key: str, n: int = 50, seed: int = 42) -> DataFrame:
    """n scored rows in draw order; all of them when there are fewer."""
    return scores.orderBy(draw_order(seed, key), key).limit(n)


def average_ranks(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the rank of a value, ties sharing their average. Rows with a null value drop out.

    Counts per distinct value are dealt by range; a value's rank is the total of the ranges before its own, plus
    the counts before it inside its range, so no task sees all values.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.repartitionByRange("_value").withColumn("part", F.spark_partition_id()), "values")
    parts = counts.groupBy("part").agg(F.sum("n").alias("held"))  # one row per task
    before = F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("_value").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.join(F.broadcast(parts.select("part", before.alias("before"))), "part")
    ranks = ranked.select("_value", (F.col("before") + inside + (F.col("n") + 1) / 2).alias(out))
    return lookup_join(df.withColumn("_value", F.col(column)), ranks, "_value").drop("_value")


def correlations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson, and Spearman as Pearson over average ranks; null when a side does not vary.

    Ranks use the values as they are. Pairs with a null or NaN on either side are left out."""
    real = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    df = materialize(df.filter(real(a) & real(b)).select(a, b), "pairs")  # read five times
    ranked = average_ranks(average_ranks(df, a, "_rank_a"), b, "_rank_b")
    pairs = {"spearman_correlation_rho": ("_rank_a", "_rank_b"), "pearson_correlation_r": (a, b)}
    sums = ranked.agg(*[f(*args).alias(f"{name}_{i}") for name, (x, y) in pairs.items() for i, (f, args) in enumerate(
        [(F.covar_pop, (x, y)), (F.stddev_pop, (x,)), (F.stddev_pop, (y,))])])

    def ratio(name: str):
        spread = F.col(f"{name}_1") * F.col(f"{name}_2")
        return F.round(F.when(spread > 0, F.col(f"{name}_0") / spread), 4).alias(name)

    return sums.select(*[ratio(name) for name in pairs])


def cohen_kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Kappa of two PASS/FAIL columns; null when chance agreement is already 1."""
    n = F.count(F.lit(1)).cast("double")
    pass_a, pass_b = F.count_if(F.col(a) == "PASS") / n, F.count_if(F.col(b) == "PASS") / n
    observed = F.count_if(F.col(a) == F.col(b)) / n
    sums = df.agg(observed.alias("po"), (pass_a * pass_b + (1 - pass_a) * (1 - pass_b)).alias("pe"))
    return sums.select(F.round(F.when(F.col("pe") < 1, (F.col("po") - F.col("pe")) / (1 - F.col("pe"))), 4).alias(
        "cohen_kappa_verdict"))


def rater_agreement(df: DataFrame) -> DataFrame:
    """One row with all agreement measures between judge and second rater. The ratings are written once and read by every measure."""
    df = materialize(df.select("human_score", "human_verdict", "overall_score", "verdict"), "ratings")
    h, j = F.col("human_score"), F.col("overall_score")
    plain = df.agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.round(F.avg((F.col("human_verdict") == F.col("verdict")).cast("double")) * 100, 2).alias(
            "verdict_agreement_percentage"),
        F.round(F.avg(F.abs(h - j)), 4).alias("mean_absolute_error"),
        F.round(F.avg(h), 2).alias("human_mean_score"), F.round(F.avg(j), 2).alias("judge_mean_score"))
    corr = correlations(df, "human_score", "overall_score")
    kappa = cohen_kappa(df, "human_verdict", "verdict")
    return plain.withColumns({
        "spearman_correlation_rho": corr.select("spearman_correlation_rho").scalar(),
        "pearson_correlation_r": corr.select("pearson_correlation_r").scalar(),
        "cohen_kappa_verdict": kappa.scalar(),
    })
