"""Reproducible evaluation sets: stratified draw, ambiguous draw, top-up, labels.

The order of a draw is the MD5 of 'seed:conversation', so it is the same on every engine and does
not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import values as V
from ..functions import text as X
from ..session import materialize
from .labels import label_all_matches

PER_INTENT, AMBIGUOUS, TARGET = 18, 20, 200


def draw_order(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def golden_pool(threads: DataFrame, dictionary=V.GOLDEN_KEYWORDS) -> DataFrame:
    """Threads with a reply and at least two words, with all matching intents."""
    usable = threads.filter(
        (X.word_count(F.col("customer_cleaned_issue")) >= 2) & (F.coalesce("brand_first_response", F.lit("")) != ""))
    return label_all_matches(usable, "customer_cleaned_issue", dictionary)


def difficulty(words: Column, turns: Column) -> Column:
    return F.when(words < 6, "hard").when((words > 25) | (turns > 3), "medium").otherwise("easy")


def single_matches(pool: DataFrame) -> DataFrame:
    """Threads that match exactly one intent, with it as their label."""
    return pool.filter(F.size("intents") == 1).withColumn("gold_intent", F.col("intents")[0])


def stratified_sample(pool: DataFrame, n: int = PER_INTENT, seed: int = 42) -> DataFrame:
    """At most n threads of every intent, from those that match exactly one."""
    single = single_matches(pool)
    place = F.row_number().over(
        Window.partitionBy("gold_intent").orderBy(draw_order(seed, "conversation_id"), "conversation_id"))
    return single.withColumn("draw_no", place).filter(F.col("draw_no") <= n)


def gold_labels(sample: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Decision and reason from the intent's risk level."""
    side = F.broadcast(taxonomy.select(F.col("name").alias("gold_intent"), "priority", "display_name", "risk_level"))
    high = F.col("risk_level") == "high"
    return sample.join(side, "gold_intent").withColumns({
        "gold_decision": F.when(high, V.ESCALATE).otherwise(V.AUTO),
        "gold_reason": F.when(high, F.concat(
            F.lit("High-risk domain ("), F.col("display_name"),
            F.lit("): requires human verification or hardware/billing authorization."))).otherwise(F.concat(
                F.lit("Standard "), F.col("display_name"),
                F.lit(" inquiry: safe to provide official troubleshooting guidance."))),
        "difficulty": difficulty(X.word_count(F.col("customer_cleaned_issue")), F.col("turn_count")),
    })


def ambiguous_sample(pool: DataFrame, n: int = AMBIGUOUS, seed: int = 42) -> DataFrame:
    """n threads that match several intents; the first one is the label, a person decides."""
    drawn = (pool.filter(F.size("intents") > 1)
             .orderBy(draw_order(seed, "conversation_id"), "conversation_id").limit(n))
    return drawn.withColumns({
        "gold_intent": F.col("intents")[0],
        "gold_decision": F.lit(V.ESCALATE),
        "gold_reason": F.concat(F.lit("Multi-issue query touching both "), F.col("intents")[0], F.lit(" and "),
                                F.col("intents")[1], F.lit("; requires human agent triage.")),
        "risk_level": F.lit("medium"),
        "difficulty": F.lit("hard"),
    })


def top_up(pool: DataFrame, chosen: DataFrame, target: int = TARGET, seed: int = 42,
           default_intent: str = V.DEFAULT_INTENT) -> DataFrame:
    """Unchosen threads that fill the set up to `target`.

    The first `target` unchosen threads in draw order are enough; of those, as many as are missing.
    """
    missing = F.lit(target) - chosen.agg(F.count(F.lit(1))).scalar()
    left = pool.join(chosen.select("conversation_id"), "conversation_id", "left_anti")
    order = [draw_order(seed, "conversation_id"), F.col("conversation_id")]
    first = left.orderBy(*order).limit(target)
    return (first.withColumn("_place", F.row_number().over(Window.orderBy(*order)))
            .filter(F.col("_place") <= missing).drop("_place").withColumns({
                "gold_intent": F.lit(default_intent),
                "gold_decision": F.lit(V.AUTO),
                "gold_reason": F.lit("General technical advice request."),
                "risk_level": F.lit("low"),
                "difficulty": F.lit("medium"),
            }))


def golden_set(threads: DataFrame, taxonomy: DataFrame, per_intent: int = PER_INTENT, ambiguous: int = AMBIGUOUS,
               target: int = TARGET, seed: int = 42, dictionary=V.GOLDEN_KEYWORDS,
               default_intent: str = V.DEFAULT_INTENT) -> DataFrame:
    """The evaluation set: stratified rows in taxonomy order, then ambiguous ones, then the top-up."""
    pool = materialize(golden_pool(threads, dictionary), "pool")
    shape = ["conversation_id", "customer_cleaned_issue", "gold_intent", "gold_decision", "gold_reason", "risk_level",
             "brand_first_response", "difficulty", "turn_count"]
    drawn = gold_labels(stratified_sample(pool, per_intent, seed), taxonomy)
    first = drawn.select(*shape, F.lit(1).alias("step"), F.col("priority").alias("stratum"))
    second = ambiguous_sample(pool, ambiguous, seed).select(*shape, F.lit(2).alias("step"), F.lit(0).alias("stratum"))
    chosen = materialize(first.unionByName(second), "chosen")
    third = top_up(pool, chosen, target, seed, default_intent).select(
        *shape, F.lit(3).alias("step"), F.lit(0).alias("stratum"))
    # numbered in one place: the set is bounded by per_intent * intents + ambiguous + target
    number = F.row_number().over(
        Window.orderBy("step", "stratum", draw_order(seed, "conversation_id"), "conversation_id"))
    return chosen.unionByName(third).withColumn("number", number).select(
        F.format_string("gold_%03d", "number").alias("id"), "conversation_id",
        F.col("customer_cleaned_issue").alias("customer_message"),
        F.col("customer_cleaned_issue").alias("conversation_context"),
        "gold_intent", "gold_decision", "gold_reason", "risk_level",
        F.col("brand_first_response").alias("reference_resolution"), "difficulty", "turn_count")


def golden_distribution(golden: DataFrame) -> DataFrame:
    """Counts and shares by intent, by decision and by difficulty, in one pass."""
    facets = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(c).alias("value")) for f, c in (
        ("intent", "gold_intent"), ("decision", "gold_decision"), ("difficulty", "difficulty"))])
    total = golden.agg(F.count(F.lit(1))).scalar()
    return (golden.select(F.explode(facets).alias("f")).groupBy("f.facet", "f.value")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("percent", F.round(F.col("n") / total * 100, 1)))
