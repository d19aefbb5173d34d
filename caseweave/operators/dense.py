"""Exact cosine top-k on dense vectors: a tree of pivots whose bounds skip groups, and blocks of scores for the groups that stay."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import is_small, lookup_join, materialize, measured, size_measures

FAN = 16  # pivots that split one group
PART_ROWS = 4096  # vectors, or queries, that are scored at a time
CLOSE = 2e-6  # more than the rounding of a similarity can hide


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def angle(a: Column, b: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b))))


def unit_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v): vectors of length one. Null, empty and zero vectors drop out."""
    x = F.transform(vector, lambda e: e.cast("double"))
    out = df.select(key, x.alias("v")).withColumn("l", F.sqrt(dot(F.col("v"), F.col("v")))).filter("l > 0")
    return out.select(key, F.transform("v", lambda e: e / F.col("l")).alias("v"))


def moved(rows: DataFrame, pivots: DataFrame, fan: int, small: bool) -> DataFrame:
    """The rows of groups that are split, each under the nearest of its group's pivots (ties: the first); other rows stay."""
    found = lookup_join(rows, pivots, "group", "left", small=small)
    near = F.array_min(F.transform("pivots", lambda p, i: F.struct(angle(F.col("v"), p).alias("angle"), i.alias("i"))))
    found = found.withColumn("near", F.when(F.col("pivots").isNotNull(), near))
    return found.withColumns({"group": F.when(F.col("near").isNull(), F.col("group")).otherwise(F.col("group") * (fan + 1) + F.col("near.i") + 1),
                              "angle": F.col("near.angle")}).drop("near", "pivots")


def pivot_tree(unit: DataFrame, asked: DataFrame, key: str, part_rows: int, fan: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(vectors with group, queries with group, tree). The tree (up, group, pivot, radius, open) grows with the table.

    A group of more than `part_rows` vectors is split by `fan` of its members, the first in the order of a hash, until all are small
    or do not split, as copies of one vector never do. A round moves every vector of a large group once; only counts,
    pivots and radii are joined to them.
    """
    unit, asked, tree = unit.withColumn("group", F.lit(0).cast("long")), asked.withColumn("group", F.lit(0).cast("long")), None
    large = unit.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part_rows)
    while True:
        large, seen = measured(large, "large", rows=F.count(F.lit(1)))
        if not seen["rows"]:
            return unit, asked, tree
        place = F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64(key), key))
        inside = lookup_join(unit, large.select("group", F.lit(True).alias("split")), "group")
        chosen = inside.withColumn("place", place).filter(F.col("place") <= fan).groupBy("group").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"]).alias("pivots"))  # `fan` vectors
        chosen, sizes = measured(chosen, "pivots", **size_measures(chosen))
        small = is_small(sizes)
        unit = materialize(moved(unit, chosen, fan, small), "members")
        asked = materialize(moved(asked, chosen, fan, small).drop("angle"), "askedvectors")
        up = F.floor((F.col("group") - 1) / (fan + 1)).cast("long")
        grown = unit.filter("angle is not null").groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).withColumn("up", up)
        grown = grown.join(large.select(F.col("group").alias("up"), F.col("n").alias("before")), "up")
        grown = grown.join(chosen.withColumnRenamed("group", "up"), "up")
        at = (F.col("group") - F.col("up") * (fan + 1)).cast("int")
        splits = (F.col("n") > part_rows) & (F.col("n") < F.col("before")) & (F.col("radius") > 1e-7)
        grown = materialize(grown.select("up", "group", F.element_at("pivots", at).alias("pivot"), "radius", "n", splits.alias("open")), "tree")
        tree = grown.drop("n") if tree is None else tree.unionByName(grown.drop("n"))
        large, unit = grown.filter("open").select("group", "n"), unit.drop("angle")


def block_scores(asks: DataFrame, members: DataFrame, key: str, k: int, part_rows: int) -> DataFrame:
    """(query_id, key, similarity): of every group a query asks, its k best other vectors, by 6 decimals, then key.

    A group is cut into parts of `part_rows` vectors by `part_rows` queries; a task multiplies one part's matrices, so it is bounded whatever
    the group's size. k rows leave each part for a query.
    """
    count = lambda df, name: df.groupBy("group").agg(F.count(F.lit(1)).alias(name))
    parts = count(members, "n").join(count(asks, "asks"), "group").select(
        "group", F.ceil(F.col("n") / part_rows).cast("int").alias("mparts"), F.ceil(F.col("asks") / part_rows).cast("int").alias("qparts"))
    parts, sizes = measured(parts, "parts", **size_measures(parts))
    dealt = lambda c, n: F.pmod(F.xxhash64(F.lit("part"), c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = lookup_join(asks, parts, "group", small=is_small(sizes)).withColumn("qpart", dealt("query_id", "qparts")).withColumn("mpart", each("mparts"))
    right = lookup_join(members, parts, "group", small=is_small(sizes)).withColumn("mpart", dealt(key, "mparts")).withColumn("qpart", each("qparts"))
    kind = dict(members.dtypes)[key]
    place = ["group", "mpart", "qpart"]

    def score(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "id": [], "similarity": []})
        if not len(queries) or not len(rows):
            return empty
        rows = rows.sort_values("id", kind="stable")
        ids, x, own, out = rows["id"].to_numpy(), np.stack(rows["v"]), rows.groupby("id").indices, [empty]
        for at in range(0, len(queries), 256):
            some = queries.iloc[at:at + 256]
            s = np.round(np.stack(some["q"]) @ x.T, 6)
            for i, q in enumerate(some["query_id"]):
                s[i, own.get(q, [])] = -np.inf
            least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] > k else np.full(len(s), -2.0)
            level = s == least[:, None]
            level &= np.cumsum(level, axis=1) <= k  # of equal ones the first keys
            i, j = np.nonzero(((s > least[:, None]) | level) & (s >= -2))
            out.append(pd.DataFrame({"query_id": some["query_id"].to_numpy()[i], "id": ids[j], "similarity": s[i, j]}))
        return pd.concat(out) if len(out) > 1 else empty

    found = left.select(*place, "query_id", "q").groupBy(*place).cogroup(right.select(*place, F.col(key).alias("id"), "v").groupBy(*place)).applyInPandas(
        score, f"query_id {kind}, id {kind}, similarity double")
    return found.withColumnRenamed("id", key)


def dense_topk(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 5, pivots: int = FAN,
               part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, key, similarity): the k most similar other vectors of every query; similarity with 6 decimals, ties by key.

    Vectors lie in the leaves of a tree of pivots. A query's own leaf gives a lower bound for its k-th best similarity; from
    the root down a group is entered only if the smallest possible angle to its members (the angle to its pivot less the
    group's radius) can reach that bound. The result is exact; on vectors without clusters few groups are skipped.
    """
    unit = materialize(unit_vectors(vectors, key, vector), "unit")
    asked = materialize(unit_vectors(queries, key, vector).withColumnRenamed(key, "query_id"), "asked")
    members, asked, tree = pivot_tree(unit, asked, key, part_rows, pivots)
    asked = asked.withColumnRenamed("v", "q")
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), key)
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    found = materialize(ranked(block_scores(asked, members, key, k, part_rows)), "own")
    if tree is not None:
        floor = F.coalesce("floor", F.lit(-2.0)) - CLOSE
        floors = found.filter(F.col("rank") == k).select("query_id", F.col("similarity").alias("floor"))
        inner = asked.join(floors, "query_id", "left").withColumnRenamed("group", "home").withColumn("up", F.lit(0).cast("long"))
        reach, met = F.cos(F.greatest(F.lit(0.0), angle(F.col("q"), F.col("pivot")) - F.col("radius"))), None
        sides, sizes = measured(tree, "tree", **size_measures(tree))
        while True:
            near = inner.join(F.broadcast(sides) if is_small(sizes) else sides, "up").filter(reach >= floor)
            near, seen = measured(near.select("query_id", "q", "home", "floor", "group", "open"), "near", inner=F.count_if("open"))
            leaves = near.filter("not open and group <> home").select("query_id", "q", "group")
            met = leaves if met is None else met.unionByName(leaves)
            if not seen["inner"]:
                break
            inner = near.filter("open").select("query_id", "q", "home", "floor", F.col("group").alias("up"))
        found = ranked(found.drop("rank").unionByName(block_scores(met, members, key, k, part_rows)))
    return found.select("query_id", "rank", key, "similarity")
