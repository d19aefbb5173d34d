"""Approximate nearest neighbours by inner product: cross-polytope hashing, multiprobe tables, exact reranking."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import in_files, join_lookup, materialize, measured, send_code


ROWS = 16_384  # vectors in one task or file


class Settings(NamedTuple):
    """`tables` hash tables, each of so many hashes that a bucket holds about `bucket_rows` vectors.

    Which buckets a query probes is decided by one threshold, fitted so that `recall` of the true neighbours of `sample`
    queries (the first in the order of a hash, compared with all vectors) stand in a probed bucket. `part_rows` vectors or
    queries of a bucket are scored at a time.
    """

    k: int = 20
    tables: int = 16
    bucket_rows: int = 4096
    recall: float = 0.96
    sample: int = 128
    part_rows: int = 4096
    cell_rows: int = 16_384
    seed: int = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The rows of x times the normalised Hadamard matrix, in d log d steps."""
    m, d = x.shape
    half = 1
    while half < d:
        pairs = x.reshape(m, d // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(m, d)
        half *= 2
    return x / math.sqrt(d)


class Hashes:
    """The pseudo-rotations of all tables; a hash value is the signed axis nearest to the rotated unit vector."""

    def __init__(self, dims: int, lifted: bool, hashes: int, s: Settings):
        self.dims, self.lifted, self.hashes, self.tables = dims, lifted, hashes, s.tables
        self.d = 1 << max(1, (dims + lifted - 1).bit_length())
        self.signs = np.random.default_rng(s.seed).choice([-1.0, 1.0], (s.tables, hashes, 3, self.d))

    def matrix(self, vectors) -> np.ndarray:
        out = np.zeros((len(vectors), self.dims))
        for i, v in enumerate(vectors):
            out[i, :len(v)] = v
        return out

    def unit(self, x: np.ndarray, longest: np.ndarray | None = None) -> np.ndarray:
        """Vectors over the largest length in their band; where lengths differ one more coordinate fills up to length one, so that
        the angle to a query, which has zero there, orders by inner product. Queries (`longest` not given) over their own length."""
        out = np.zeros((len(x), self.d))
        if longest is None:
            most = np.abs(x).max(axis=1, initial=0)
            longest = np.sqrt(((x / most[:, None]) ** 2).sum(axis=1)) * most
            out[:, :self.dims] = x / longest[:, None]
        else:
            out[:, :self.dims] = x / longest[:, None]
            if self.lifted:
                out[:, self.dims] = np.sqrt(np.maximum(0.0, 1.0 - (out ** 2).sum(axis=1)))
        return out

    def rotated(self, u: np.ndarray, table: int, number: int) -> np.ndarray:
        for signs in self.signs[table, number]:
            u = hadamard(u * signs)
        return u

    def axes(self, u: np.ndarray) -> np.ndarray:
        """(tables, hashes, rows): 2 * coordinate, plus one for its negative side."""
        out = np.empty((self.tables, self.hashes, len(u)), np.int64)
        for t in range(self.tables):
            for j in range(self.hashes):
                z = self.rotated(u, t, j)
                best = np.abs(z).argmax(axis=1)
                out[t, j] = 2 * best + (z[np.arange(len(u)), best] < 0)
        return out

    def coded(self, axes: np.ndarray) -> np.ndarray:
        """(tables, rows): the hash values of a table as one number."""
        code = np.zeros((self.tables, axes.shape[2]), np.int64)
        for j in range(self.hashes):
            code = code * (2 * self.d) + axes[:, j]
        return code

    def signed(self, u: np.ndarray, table: int, number: int) -> np.ndarray:
        """The query's coordinate on every signed axis."""
        z = self.rotated(u, table, number)
        return np.stack([z, -z], axis=2).reshape(len(u), 2 * self.d)

    def reach(self, queries: np.ndarray, axes: np.ndarray) -> np.ndarray:
        """(queries, rows): how near, in its best table, the query stands to the bucket of the row."""
        return np.max([sum(self.signed(queries, t, j)[:, axes[t, j]] for j in range(self.hashes)) for t in range(self.tables)], axis=0)

    def probes(self, queries: np.ndarray, threshold: float) -> list[np.ndarray]:
        """For every query the codes, table by table, of the buckets whose axes it reaches by `threshold` in sum; its own at
        least. A code is counted on from its table's first."""
        found, span = [[] for _ in queries], (2 * self.d) ** self.hashes
        for t in range(self.tables):
            on = [self.signed(queries, t, j) for j in range(self.hashes)]
            most = np.array([a.max(axis=1) for a in on])
            least = np.minimum(threshold, most.sum(axis=0)) - 1e-12
            who, codes, sums = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries))
            for j, a in enumerate(on):
                total = sums[:, None] + a[who]
                row, axis = np.nonzero(total >= (least - most[j + 1:].sum(axis=0))[who, None] - 1e-12)
                who, codes, sums = who[row], codes[row] * (2 * self.d) + axis, total[row, axis]
            for q, c in zip(who, codes):
                found[q].append(t * span + c)
        return [np.array(f, np.int64) for f in found]


def band_of(norm: Column) -> Column:
    """Vectors whose lengths are within a factor of two; lengths of about one stand in the middle of a band."""
    return F.floor(F.log2(norm) + 0.5).cast("int")


def usable_rows(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """row, id, v, uid, norm: rows that can take part, with a running number and a digest of the vector."""
    x = F.col(vector).cast("array<double>")
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))) & F.exists(x, lambda e: e != 0)
    out = vectors.filter(F.col(id_).isNotNull() & F.col(vector).isNotNull()).filter(good).select(F.col(id_).cast("long").alias("id"), x.alias("v"))
    most = F.array_max(F.transform("v", F.abs))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + (e / F.col("most")) * (e / F.col("most")))) * F.col("most")
    return out.withColumn("most", most).select(F.monotonically_increasing_id().alias("row"), "id", "v", length.alias("norm"),
                                               F.md5(F.array_join(F.transform("v", lambda e: e.cast("string")), ",")).alias("uid"))


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, e: t + F.coalesce(e, F.lit(0.0)))


def fitted(members: DataFrame, asked: DataFrame, h: Hashes, longest: dict[int, float], s: Settings) -> float:
    """The threshold at which `recall` of the true neighbours of the sample queries are reached.

    The sample is compared with every vector where the vectors lie; each batch of rows passes on its k best of each query.
    """
    rows = asked.orderBy(F.xxhash64("uid"), "uid").limit(s.sample).collect()  # `sample` vectors
    queries = h.matrix([r["v"] for r in rows])
    units = h.unit(queries)
    own = np.array([r["uid"] for r in rows])

    def best(batches):
        for b in batches:
            x = h.matrix(b["v"])
            scores = queries @ x.T
            scores[own[:, None] == b["uid"].to_numpy()[None]] = -np.inf
            top = np.argsort(-scores, axis=1)[:, :s.k]
            met, place = np.unique(top, return_inverse=True)
            reach = h.reach(units, h.axes(h.unit(x[met], b["band"].map(longest).to_numpy(float)[met])))
            yield pd.DataFrame({"q": np.repeat(np.arange(len(own)), top.shape[1]), "score": np.take_along_axis(scores, top, 1).ravel(),
                                "reach": np.take_along_axis(reach, place.reshape(top.shape), 1).ravel()})

    near = members.select("uid", "v", "band").mapInPandas(best, "q long, score double, reach double").filter("score > double('-Infinity')")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.desc("reach")))
    near = near.withColumn("rank", rank).filter(F.col("rank") <= s.k)
    found = near.agg(F.percentile("reach", F.lit(1 - s.recall))).first()[0]
    return -math.inf if found is None else found


def scored(probes: DataFrame, members: DataFrame, s: Settings, buckets: int) -> DataFrame:
    """q, w, low, high: for every probed bucket the vectors that can be among a query's k + 1 best there.

    Vectors stand in the tables as bytes, so scores are known within a bound. Buckets are cut into parts of `part_rows` vectors by
    `part_rows` queries, which are dealt to tasks; a bucket's size decides the number of its parts only.
    """
    sizes = in_files(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).join(
        probes.groupBy("bucket").agg(F.count(F.lit(1)).alias("asks")), "bucket").select(
            "bucket", "n", F.ceil(F.col("n") / s.part_rows).cast("int").alias("mparts"), F.ceil(F.col("asks") / s.part_rows).cast("int").alias("qparts")), buckets)
    sizes = materialize(sizes, "sizes")
    total = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("qparts")), F.lit(0))).first()[0]
    cells = max(1, -(-total // s.cell_rows))
    part = lambda key, parts: F.pmod(F.xxhash64(key, F.lit(s.seed)), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    cell = F.pmod(F.xxhash64("bucket", "mpart", "qpart"), F.lit(cells)).cast("int")
    sides = sizes.drop("n")
    left = join_lookup(probes, sides, "bucket", "inner").withColumn("qpart", part("q", "qparts")).withColumn("mpart", each("mparts"))
    right = join_lookup(members, sides, "bucket", "inner").withColumn("mpart", part("w", "mparts")).withColumn("qpart", each("qparts"))
    left = left.withColumn("cell", cell).select("cell", "bucket", "mpart", "qpart", "q", "vector")
    right = right.withColumn("cell", cell).select("cell", "bucket", "mpart", "qpart", "w", "scale", "bytes")
    wanted = s.k + 1

    def score(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"q": [], "w": [], "low": [], "high": []}).astype({"q": "int64", "w": "int64", "low": "float64", "high": "float64"})]
        group = ["bucket", "mpart", "qpart"]
        blocks = dict(list(rows.groupby(group, sort=False)))
        for key, asks in queries.groupby(group, sort=False):
            block = blocks.get(key)
            if block is None:
                continue
            w, scale = block["w"].to_numpy(), block["scale"].to_numpy()
            x = np.stack([np.frombuffer(b, np.int8) for b in block["bytes"]]).astype(np.float64) * scale[:, None]
            for at in range(0, len(asks), 256):
                some = asks.iloc[at:at + 256]
                y = np.stack([np.frombuffer(b, np.float64) for b in some["vector"]])
                scores = y @ x.T
                off = 0.500001 * np.abs(y).sum(axis=1)[:, None] * scale[None]
                low = scores - off
                if len(w) > wanted:
                    floor = np.partition(low, len(w) - wanted, axis=1)[:, len(w) - wanted]
                    i, j = np.nonzero(scores + off >= floor[:, None])
                else:
                    i, j = (a.ravel() for a in np.indices(low.shape))
                out.append(pd.DataFrame({"q": some["q"].to_numpy()[i], "w": w[j], "low": low[i, j], "high": low[i, j] + 2 * off[i, j]}))
        return pd.concat(out)

    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInPandas(score, "q long, w long, low double, high double")
    found = found.groupBy("q", "w").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("low"), "w"))
    floor = F.max(F.when(F.col("place") == wanted, F.col("low"))).over(Window.partitionBy("q"))
    return found.withColumn("place", place).withColumn("floor", floor).filter("floor is null or high >= floor").select("q", "w")


def reranked(pairs: DataFrame, distinct: DataFrame, asked: DataFrame, s: Settings) -> DataFrame:
    """q, row, id, score: the k + 1 best rows of the candidate vectors, copies included, by exact score, then id."""
    exact = pairs.join(distinct.select(F.col("w"), F.col("v").alias("x"), "ids"), "w").join(asked.select("q", F.col("v").alias("y")), "q")
    exact = exact.select("q", dot("y", "x").alias("score"), "ids")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "e.id", "e.row"))
    return exact.select("q", "score", F.explode("ids").alias("e")).withColumn("place", rank).filter(F.col("place") <= s.k + 1).select(
        "q", "e.row", "e.id", "score")


def search(vectors: DataFrame, every: int = 20, id_: str = "vec_id", vector: str = "embedding", s: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every row whose id is divisible by `every`.

    Equal vectors are one entry of the index, with the k + 1 smallest ids; all queries with one vector share its answer, so copies, however
    many, cost one vector. Every entry stands in `tables` buckets. Queries probe the buckets that the fitted threshold gives;
    the candidates' scores are exact inner products in double precision. A query that finds fewer than k rows is
    compared with all entries, in the blocks that one table gives.

    Rows without an id and vectors that are null, empty, zero or hold a null or non-finite component take no part; shorter vectors
    end in zeros. Repeated ids are rows of their own: a query leaves out its own row only. Fewer than k candidates: all of
    them. Ties go to the smaller id. Empty table: no rows.
    """
    send_code(vectors.sparkSession)
    rows, seen = measured(usable_rows(vectors, id_, vector), "vectors", rows=F.count(F.lit(1)), asks=F.count_if(F.col("id") % every == 0))
    dealt = lambda df, n, key: df.repartition(max(1, -(-n // ROWS)), key)
    entry = F.struct("id", "row")
    few = rows.withColumn("place", F.row_number().over(Window.partitionBy("uid").orderBy("id", "row"))).filter(F.col("place") <= s.k + 1)
    distinct = few.groupBy("uid").agg(F.min("row").alias("w"), F.first("v").alias("v"), F.first("norm").alias("norm"), F.sort_array(F.collect_list(entry)).alias("ids"))
    distinct = materialize(in_files(distinct.withColumn("band", band_of(F.col("norm"))), seen["rows"], ROWS), "distinct")
    queries = rows.filter(F.col("id") % every == 0).select("row", F.col("id").alias("query_id"), "uid")
    asked = rows.filter(F.col("id") % every == 0).groupBy("uid").agg(F.min("row").alias("q"), F.first("v").alias("v"))
    asked = materialize(in_files(asked, seen["asks"], ROWS), "asked")
    bands = distinct.groupBy("band").agg(F.max("norm").alias("most"), F.min("norm").alias("least")).collect()  # one row for each power of two
    n, dims, total = distinct.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if(F.size("ids") > s.k)).first()
    longest = {b["band"]: b["most"] for b in bands}
    lifted = any(b["least"] < 0.999 * b["most"] for b in bands)
    axes = 2 << max(1, ((dims or 1) + lifted - 1).bit_length())
    h = Hashes(dims or 1, lifted, max(1, round(math.log(max(1, n) / s.bucket_rows, axes))), s)
    threshold = fitted(distinct, asked, h, longest, s)  # -inf without queries or neighbours
    numbers = {b: i for i, b in enumerate(sorted(longest))}
    span = axes ** h.hashes

    def index(batches):
        for b in batches:
            x = h.matrix(b["v"])
            codes = h.coded(h.axes(h.unit(x, b["band"].map(longest).to_numpy(float))))
            tables = b["band"].map(numbers).to_numpy(np.int64) * h.tables + np.arange(h.tables)[:, None]
            scale = np.abs(x).max(axis=1) / 127
            yield pd.DataFrame({"w": b["w"], "scale": scale, "bytes": [r.tobytes() for r in np.rint(x / scale[:, None]).astype(np.int8)],
                                "buckets": list((tables * span + codes).T)})

    def ask(batches):
        for b in batches:
            y = h.matrix(b["v"])
            for at in range(0, len(y), 64):  # so few that their partial sums stay small
                some = y[at:at + 64]
                yield pd.DataFrame({"q": b["q"][at:at + 64], "vector": [r.tobytes() for r in some],
                                    "buckets": [np.concatenate([i * h.tables * span + p for i in numbers.values()]) for p in h.probes(h.unit(some), threshold)]})

    members = materialize(dealt(distinct.select("w", "v", "band"), n, "w").mapInPandas(index, "w long, scale double, bytes binary, buckets array<long>"), "members")
    probes = materialize(dealt(asked.select("q", "v"), 16 * seen["asks"], "q").mapInPandas(ask, "q long, vector binary, buckets array<long>"), "probes")
    spread = lambda df: df.withColumn("bucket", F.explode("buckets")).drop("buckets")
    best = reranked(scored(spread(probes), spread(members), s, s.tables * n), distinct, asked, s)
    best = materialize(in_files(best, (s.k + 1) * seen["asks"], 4 * ROWS), "best")
    most = distinct.agg(F.sum(F.size("ids"))).first()[0] or 0  # copies beyond k + 1 are never asked for
    found = best.groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    short = probes.join(found, "q", "left").filter(F.coalesce("n", F.lit(0)) < min(s.k + 1, most)).select("q", "vector")
    short = materialize(in_files(short, seen["asks"], ROWS), "short")
    if short.first():
        blocks = -(-n // s.part_rows)
        everything = members.withColumn("bucket", F.pmod(F.xxhash64("w"), F.lit(blocks))).drop("buckets")
        again = short.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        best = best.join(short, "q", "left_anti").unionByName(reranked(scored(again, everything, s, blocks), distinct, asked, s))
    listed = best.groupBy("q").agg(F.collect_list(F.struct("row", "id", "score")).alias("found"))  # k + 1 entries
    answers = join_lookup(queries, asked.select("q", "uid").join(listed, "q").drop("q"), "uid", "inner")
    answers = answers.select(F.col("row").alias("own"), "query_id", F.explode("found").alias("e")).filter("e.row <> own")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("e.score"), "e.id", "e.row"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= s.k).select("query_id", "rank", F.col("e.id").alias("vec_id"), F.col("e.score").alias("score"))
