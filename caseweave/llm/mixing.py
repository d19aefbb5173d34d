"""Temperature mixing of sources: weights by entropy or repetition, realised as budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import is_small, materialize, measured, size_measures

BLOCKS = 256
SUBBLOCKS = 4096
STEPS = 30


def estimated_tokens(text: str = "text") -> Column:
    """A token for every four bytes, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.octet_length(F.coalesce(F.col(text), F.lit(""))) / F.lit(4))).cast("long")


def order_hash(seed: int, *parts) -> Column:
    """60 bits of MD5 over the seed and the parts: the same everywhere, in SQL too."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def entropy_at(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy, largest repetition over the smallest) of the weights share^e / sum, for several e in one pass.

    The repetition of a source is proportional to share^(e - 1), so the ratio of the largest to the smallest is
    that of the smallest and the largest share to the power 1 - e."""
    terms = []
    for i, e in enumerate(exponents):
        w = F.pow("share", F.lit(e))
        terms += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log("share")).alias(f"l{i}")]
    row = shares.agg(F.min("share").alias("low"), F.max("share").alias("high"), *terms).first()
    return [(math.log(row[f"z{i}"]) - e * row[f"l{i}"] / row[f"z{i}"], (row["high"] / row["low"]) ** (1 - e))
            for i, e in enumerate(exponents)]


def find_exponent(shares: DataFrame, entropy: float, repetition: float) -> float:
    """The exponent in [0, 1] for `entropy` (a part of the largest possible, log of the number of sources).

    Flattening (a smaller exponent) raises both the entropy and the repetition of small sources against large
    ones. The exponent is the largest one that reaches the entropy, raised where the repetition limit asks for
    it. Bisection, several levels in one pass over the sources: each pass tries 2^6 - 1 points.
    """
    n = shares.count()
    if n < 2:
        return 1.0
    target = entropy * math.log(n)
    low, high, level = 0.0, 1.0, 6
    for _ in range(STEPS // level):
        width = (high - low) / 2 ** level
        points = [low + width * k for k in range(1, 2 ** level)]
        found = entropy_at(shares, points)
        down = sum(r > repetition for _, r in found)  # points below this break the limit
        up = sum(h >= target for h, _ in found)  # points up to this reach the entropy
        step = max(down, up)
        low, high = low + width * step, low + width * (step + 1)
    return high if entropy_at(shares, [low])[0][1] > repetition else low


def mix(docs: DataFrame, entropy: float = 0.97, repetition: float = 2.0, budget: int | None = None,
        seed: int = 7, tokens: Column | None = None) -> DataFrame:
    """The rows of `docs`, each as often as the mix asks for, with all their columns and those of _mix:
    struct(tokens, epoch, block, block_turn, turn). Their order is (epoch, block_turn, turn): see `in_order`.

    Weights are share^e normalised, e from `find_exponent`. `budget` is the number of tokens of the mix; by
    default it is the least with which every source is read at least once in full, so no document is lost
    and none is read more than `repetition` times (rounded up). A source of T tokens and weight w gets
    w * budget tokens: whole epochs, then part of a last one. An epoch is a permutation of the source's blocks
    (hash ranges of doc_ids) and, by a hash of the epoch, of the documents inside each; the last epoch takes its blocks, and of the
    block where the budget ends the documents in the order of their hash, as long as their running sum stays within what is left.

    The running sum is taken over blocks, then over the parts of the one block where the budget ends, then over
    the documents of that part: no task ever orders a whole source. The plan of a source is joined back by
    (source, block), so a hot source is spread over its blocks.

    Null source: taken as the source with the empty name. Fewer than one token counts as one. Null or empty text: one token. Null doc_id: hashed as empty. Repeated
    rows (same id) are kept or left together. Empty table: no rows. A column named _mix is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("_mix")
    kept = docs.columns
    keyed = docs.select(
        F.struct(*kept).alias("row"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        F.col("doc_id").cast("long").alias("_id"), F.greatest(estimated_tokens() if tokens is None else tokens, F.lit(1)).cast("long").alias("_tokens"))
    keyed = keyed.withColumn("_hash", order_hash(seed, F.col("_id")))
    keyed = keyed.withColumn("_block", F.shiftright("_hash", 52).cast("int"))
    narrow = keyed.select("_source", "_block", "_hash", "_id", "_tokens")
    blocks = materialize(narrow.groupBy("_source", "_block").agg(F.sum("_tokens").alias("tokens")), "blocks")
    sources = materialize(blocks.groupBy("_source").agg(F.sum("tokens").alias("total")), "sources")
    everything = sources.agg(F.sum("total")).first()[0]
    if not everything:
        return docs.withColumn("_mix", F.lit(None).cast(MIX)).limit(0)
    shares = sources.withColumn("share", F.col("total") / F.lit(float(everything)))
    e = find_exponent(shares, entropy, repetition)
    weight = F.pow("share", F.lit(e))
    z, least = shares.agg(F.sum(weight), F.max(F.col("total") / weight)).first()
    size = math.ceil(least * z) if budget is None else budget
    # a part of a token is added before rounding down, so that exact whole epochs do not lose a document
    wanted = F.floor(weight / F.lit(z) * F.lit(float(size)) + F.lit(1e-3)).cast("long")
    if budget is None:  # rounding the budget up must not break the limit
        wanted = F.least(wanted, F.floor(F.col("total") * F.lit(repetition)).cast("long"))
    plan = materialize(shares.select("_source", F.floor(wanted / F.col("total")).cast("int").alias("epochs"),
                                     (wanted % F.col("total")).alias("left")), "mixplan")

    def cut(parts: DataFrame, key: str, by: list[str], left: str) -> DataFrame:
        """Parts with the sum before them and a state: 0 inside the budget, 1 where it ends, 2 beyond."""
        before = F.coalesce(F.sum("tokens").over(Window.partitionBy(*by).orderBy("turn", key)
                                                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return parts.withColumn("before", before).withColumn(
            "state", F.when(F.col("before") + F.col("tokens") <= F.col(left), 0)
            .when(F.col("before") <= F.col(left), 1).otherwise(2)).withColumn("rest", F.col(left) - F.col("before"))

    turn = order_hash(seed, F.col("_source"), F.col("epochs"), F.col("_block"))
    blocks = materialize(cut(blocks.join(plan, "_source").withColumn("turn", turn), "_block", ["_source"], "left")
                         .select("_source", "_block", "epochs", "state", "rest"), "mixblocks")
    ends = blocks.filter("state = 1").select("_source", "_block", F.col("rest").alias("left"))
    sub = F.shiftright("_hash", 40) % F.lit(SUBBLOCKS)
    inner = joined(narrow, ends, ["_source", "_block"]).withColumn("_sub", sub)
    subs = inner.groupBy("_source", "_block", "_sub").agg(F.sum("_tokens").alias("tokens"), F.first("left").alias("left"))
    subs = materialize(cut(subs.withColumn("turn", F.lit(0)), "_sub", ["_source", "_block"], "left")
                       .filter("state = 1").groupBy("_source", "_block").agg(F.min_by(F.struct("_sub", "rest"), "_sub").alias("end"))
                       .select("_source", "_block", "end._sub", "end.rest"), "mixparts")
    ids = joined(inner, subs, ["_source", "_block", "_sub"]).groupBy("_source", "_hash").agg(
        F.sum("_tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = F.sum("tokens").over(Window.partitionBy("_source").orderBy("_hash").rowsBetween(
        Window.unboundedPreceding, 0))
    last = ids.withColumn("sum", running).filter("sum <= rest").groupBy("_source").agg(F.max("_hash").alias("end_hash"))
    ends = subs.select("_source", F.col("_sub").alias("end_sub")).join(last, "_source", "left")
    blocks = blocks.join(ends, "_source", "left")
    rows = joined(keyed, blocks.select("_source", "_block", "epochs", "state", "end_sub", "end_hash"), ["_source", "_block"])
    part = F.when(F.col("state") != 1, F.col("state") == 0).otherwise(
        (sub < F.col("end_sub")) | (F.col("_hash") <= F.coalesce("end_hash", F.lit(-1))))
    copies = F.col("epochs") + F.when(part, 1).otherwise(0)
    rows = rows.withColumn("_copies", copies).filter("_copies > 0")
    rows = rows.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    mixed = F.struct(F.col("_tokens").alias("tokens"), F.col("_epoch").cast("int").alias("epoch"), F.col("_block").alias("block"),
                     order_hash(seed, F.col("_source"), F.col("_epoch"), F.col("_block")).alias("block_turn"),
                     order_hash(seed, F.col("_id"), F.col("_epoch")).alias("turn"))
    return rows.select("row.*", mixed.alias("_mix"))


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of a mix in its order, without _mix: epoch after epoch, the blocks of all sources mixed, so that files and tasks hold
    them as training is to read them and the copies of a document are epochs apart."""
    order = ["_mix.epoch", "_mix.block_turn", "_mix.turn"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_mix")


MIX = "struct<tokens: bigint, epoch: int, block: int, block_turn: bigint, turn: bigint>"


def joined(left: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join to a plan: the side is written and measured, and broadcast only if it is small."""
    side, sizes = measured(side, "mixside", **size_measures(side))
    return left.join(F.broadcast(side) if is_small(sizes) else side, keys)
