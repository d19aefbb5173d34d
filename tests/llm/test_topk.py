import numpy as np
import pytest

from caseweave.llm import topk


def brute(rows, k, every=20):
    vs = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in vs:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vs if j != i)[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("block,group", [(8192, 512), (70, 3)])
def test_against_brute_force(spark, block, group):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 12).astype(np.float32)]) for i in range(300)]
    rows += [(i, [0.25, -0.5] + [0.0] * 10) for i in range(300, 420)]  # many equal vectors: ties go to the smaller id
    rows += [(1001, None), (1002, [None] * 12), (1003, [float("nan")] * 12), (1004, [float("inf")] * 12), (None, [0.1] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS block", "3 AS id", "4 AS v")
    got = {tuple(r) for r in topk.search(df, k=7, block_rows=block, query_rows=group).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute(rows, 7)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [0.5]), (20, [-1.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.search(df).collect()} == {(0, 1, 1, 1024), (0, 2, 20, -2048), (20, 1, 0, -2048), (20, 2, 1, -2048)}
    assert topk.search(df.limit(0)).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (1, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, k=5).collect())
    assert got == sorted([(1, 1, 2048), (2, 20, 0), (3, 20, 0)] + 2 * [(1, 20, 4096), (2, 1, 1024), (3, 20, 0)])


def test_reading_stops_early():
    """With one long vector among short ones the lists are not read to their ends."""
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, (4000, 8))
    v[17] = 1000
    lists = topk.SortedLists(np.arange(4000), v)
    ids, scores = lists.top(np.full(8, 5), 1, -1)
    assert ids.tolist() == [17] and scores.tolist() == [40000]


@pytest.mark.parametrize("scale", [20, 2_000_000])
def test_queries_are_answered_together(scale):
    """Many queries in one call, equal vectors, repeated ids and whole numbers beyond 2^24: as plain sorting gives them."""
    rng = np.random.default_rng(3)
    v = np.floor(rng.normal(0, scale, (1500, 6))).astype(np.int64)
    v[1200:] = v[900:1200]
    ids, rows = np.concatenate([np.arange(1400), np.arange(100)]), np.arange(1500)
    q = np.concatenate([np.arange(0, 1500, 10), [0]])
    queries = v[q]
    queries[-1] = 0  # no list is read for it
    found = topk.SortedLists(ids, v, rows).tops(queries, 5, rows[q])
    assert len(found) == len(q) > topk.TOGETHER
    for own, query, (got, scores) in zip(q, queries, found):
        products = v @ query
        best = [i for i in np.lexsort((ids, -products)) if i != own][:5]
        assert got.tolist() == ids[best].tolist() and scores.tolist() == products[best].tolist()
