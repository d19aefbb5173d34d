"""Exact top-k inner products by aggregation of sorted lists without random access."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, send_code

BAND = 3 / 8  # part of a list read between two looks at the bounds
LEADERS = 4  # times k: objects whose scores are resolved at each look
CONTENDERS = 32  # times k: so few that can still qualify are resolved instead of reading on
TOGETHER = 64  # queries answered at a time


def integer_vectors(rows: DataFrame, id_: str, vector: str, scale: int) -> DataFrame:
    """id long, v array<long>: floor(scale * x) of every component; rows that are null or hold a null or
    non-finite component are left out."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(vector).isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    return rows.filter(usable & F.col(id_).isNotNull()).select(F.col(id_).cast("long").alias("id"), whole.alias("v"))


class SortedLists:
    """One list of a block's vectors for each component, sorted by value; read from the top where the query's
    weight is positive and from the bottom where it is negative. Queries are answered together: what the lists have
    shown at one depth is a matrix, by which the weights of all queries are multiplied."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.v, self.rows = ids[by_id], vectors[by_id], ids[by_id] if rows is None else rows[by_id]
        self.exact = self.v.astype(np.float64)  # products of 64 * x stay below 2^53
        n, v = len(ids), np.ascontiguousarray(self.exact.T)
        rising = np.argsort(v, axis=1, kind="stable")
        place = np.empty(v.shape, np.int32)
        np.put_along_axis(place, rising, np.arange(n, dtype=np.int32)[None], axis=1)
        self.least, self.most = v.min(axis=1), v.max(axis=1)
        self.above = np.concatenate([v - self.least[:, None], self.most[:, None] - v])  # what an entry has more than the least one of its list
        self.place = np.concatenate([n - 1 - place, place])  # lists from the top, then from the bottom

    def shown(self, read: int, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, possible, next): by list and object the parts met in the first `read` entries, the same with the value that the list has
        come down to where the object was not met, and these values."""
        met = self.place < read
        next_ = np.where(met, 0, self.above).max(axis=1)
        return np.where(met, self.above, 0).astype(kind), np.where(met, self.above, next_[:, None]).astype(kind), next_

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """`tops` of one query."""
        return self.tops(query[None], k, np.array([own]))[0]

    def tops(self, queries: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of the k best by score, then id, without the query's own row.

        Entries are read in bands. An object's lower bound takes its known parts and the least value of each
        list it was not met in; its upper bound takes the values the lists have come down to. At each look the
        objects that lead by their lower bounds are resolved; their k-th best score is what the others have to
        reach. A query is done when no object outside can reach it and few of those met still can. These are
        resolved in full, so ties are decided exactly.
        """
        n, found = len(self.ids), [None] * len(queries)
        whole = queries.astype(np.float64)
        weights = np.concatenate([np.maximum(whole, 0), np.maximum(-whole, 0)], axis=1)
        base = weights @ np.concatenate([self.least, -self.most])  # the least part of each list
        largest = (weights @ self.above.max(axis=1)).max(initial=0)
        kind = np.float32 if largest < 2 ** 24 else np.float64  # sums of whole numbers are exact up to there
        weights = weights.astype(kind)
        best, open_, read, band = np.full(len(queries), -np.inf), np.arange(len(queries)), 0, max(256, int(BAND * n))
        while len(open_):
            read = min(n, read + band)
            known, possible, next_ = self.shown(read, kind)
            left = []
            for low in range(0, len(open_), TOGETHER):
                some = open_[low:low + TOGETHER]
                lower = weights[some] @ known
                for i, values in zip(some, lower) if n > LEADERS * k else ():
                    leaders = leading(values, LEADERS * k)
                    scores = self.exact[leaders[self.rows[leaders] != own[i]]] @ whole[i]
                    if len(scores) >= k:
                        best[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
                if read == n:
                    upper = lower
                else:
                    closed = base[some] + weights[some] @ next_ < best[some]  # nothing that no list has shown can reach it
                    left.extend(some[~closed])
                    some = some[closed]
                    upper = weights[some] @ possible
                reach = upper >= (best[some] - base[some])[:, None]
                few = (reach.sum(axis=1) <= CONTENDERS * k) | (read == n)
                left.extend(some[~few])
                for i, rest in zip(some[few], reach[few]):
                    rest = np.flatnonzero(rest)
                    rest = rest[self.rows[rest] != own[i]]
                    scores = (self.exact[rest] @ whole[i]).astype(np.int64)
                    keep = np.lexsort((self.ids[rest], -scores))[:k]
                    found[i] = self.ids[rest][keep], scores[keep]
            open_ = np.array(left, dtype=np.int64)
        return found


def leading(values: np.ndarray, n: int) -> np.ndarray:
    """The places of at least n values that no other exceeds; more, if some equal the least of them. The best of each of many
    stretches are compared first, so that few values are sorted."""
    step = max(1, len(values) // (4 * n))
    heads = np.maximum.reduceat(values, np.arange(0, len(values), step))
    near = np.flatnonzero(values >= np.partition(heads, len(heads) - n)[len(heads) - n])
    return near[np.argpartition(values[near], len(near) - n)[len(near) - n:]]


def search(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_: str = "vec_id", vector: str = "embedding",
           block_rows: int = 24_576, query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of each query among all rows but its own.

    Queries are the rows whose id is divisible by `every`. Candidates are dealt by a hash of the id into blocks of about
    `block_rows`, queries into groups of about `query_rows`; a task takes one block and one group of queries at a
    time, sorts the block's lists once and answers each query. Each (query, block) gives k rows at most, which are
    ranked by score, then vec_id. Both counts follow the measured number of rows, so a task's size does not grow.

    Rows without an id, and vectors that are null or hold a null or non-finite component, take no part; vectors
    shorter than the longest are taken as ending in zeros; an empty vector scores 0. Repeated ids are rows of their own: a query
    leaves out its own row only, and each such query has its own ranks.
    Fewer than k candidates: all of them. Empty table: no rows.
    """
    send_code(vectors.sparkSession)
    rows = materialize(integer_vectors(vectors, id_, vector, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-n // block_rows))
    wanted = rows.filter(F.col("id") % F.lit(every) == 0)
    groups = max(1, -(-wanted.count() // query_rows))
    dims = dims or 0

    def matrix(values) -> np.ndarray:
        out = np.zeros((len(values), dims), np.int64)
        for i, v in enumerate(values):
            out[i, :len(v)] = v
        return out

    def answer(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            lists = SortedLists(block["id"].to_numpy(np.int64), matrix(block["v"]), block["row"].to_numpy(np.int64))
            own = queries["row"].to_numpy(np.int64)
            for id_, row, (ids, scores) in zip(queries["id"].to_numpy(np.int64), own, lists.tops(matrix(queries["v"]), k, own)):
                found.append(pd.DataFrame({"own": row, "query_id": id_, "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"own": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    bucket = lambda parts, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts)).cast("int")
    left = (wanted.withColumn("part", bucket(groups, 1))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = rows.withColumn("block", bucket(blocks, 2)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    near = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInPandas(answer, "own long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
