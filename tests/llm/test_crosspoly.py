import numpy as np
import pytest

from caseweave.llm import crosspoly

NAN, INF = float("nan"), float("inf")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k=20, every=20):
    """For every query row (query_id, [(score, id), ...]), best first, all other rows in order."""
    rows = [(i, v) for i, v in rows if i is not None and usable(v)]
    d = max((len(v) for _, v in rows), default=0)
    x = np.array([[*v, *[0.0] * (d - len(v))] for _, v in rows])
    return [(i, sorted(((-float(s), j) for (j, _), s, n in zip(rows, x @ x[at], range(len(rows))) if n != at))[:k])
            for at, (i, _) in enumerate(rows) if i % every == 0]


def answers(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS row", "3 AS id", "'x' AS uid", "4 AS v", "5 AS bucket")
    out = {}
    for r in crosspoly.search(df, s=crosspoly.Settings(**settings)).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(found) for q, found in out.items()}


def recall(got, want):
    hits = sum(len({v for _, v, _ in got.get(q, [])} & {j for _, j in best}) for q, best in want)
    return hits / sum(len(best) for _, best in want)


@pytest.mark.parametrize("lengths,bucket_rows", [(False, 4096), (True, 4096), (False, 4)])
def test_recall_scores_and_order(spark, lengths, bucket_rows):
    """Vectors without clusters, of one length or of lengths from 2^-6 to 2^6; one or two hashes a table."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if lengths:
        x *= np.exp2(rng.uniform(-6, 6, 3000))[:, None]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    got, want = answers(spark, rows, bucket_rows=bucket_rows, part_rows=300), brute(rows)
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        assert all(abs(s - float(x[q] @ x[v])) <= 1e-12 * max(1, abs(s)) for _, v, s in found)


def test_copies_repeated_ids_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(600)] + [(20, [1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0]), (21, same)]
    rows += [(700 + i, [float(a) for a in rng.normal(size=3)]) for i in range(300)]
    rows += [(1000, None), (1020, []), (1040, [0.0, -0.0]), (1060, [NAN, 1.0]), (1080, [INF]), (1100, [None, 1.0]), (None, same), (1120, [2.0])]
    got = answers(spark, rows)
    want = brute(rows)
    assert recall(got, [w for w in want if w[0] != 20]) >= 0.9
    assert {1000, 1020, 1040, 1060, 1080, 1100}.isdisjoint(set(got) | {v for f in got.values() for _, v, _ in f})
    assert [v for _, v, _ in got[40][:20]] == [j for _, j in brute(rows)[2][1]]  # copies: the smallest ids, twice 21 among them
    assert len(got[20]) == 60  # three rows of one id are three queries


def test_few_and_none(spark):
    rows = [(0, [0.5]), (1, [0.5]), (20, [-1.0])]
    assert answers(spark, rows) == {0: [(1, 1, 0.25), (2, 20, -0.5)], 20: [(1, 0, -0.5), (2, 1, -0.5)]}
    assert answers(spark, []) == {} and answers(spark, [(20, [1.0])]) == {} and answers(spark, [(1, [1.0]), (2, [1.0])]) == {}
    opposite = [(i, [1.0 if i else -1.0, 0.01 * i]) for i in range(30)]  # nothing but its own vector is in the query's buckets
    assert [v for _, v, _ in answers(spark, opposite, recall=0.01)[0]] == [j for _, j in brute(opposite)[0][1]]


def test_given_vectors(spark, given):
    rows = [(r["vec_id"], r["embedding"]) for r in given("embeddings").collect()]
    assert recall(answers(spark, rows), brute(rows)) >= 0.9


def test_rotations_keep_lengths_and_axes():
    h = crosspoly.Hashes(5, False, 2, crosspoly.Settings(tables=3))
    u = h.unit(np.random.default_rng(0).normal(size=(50, 5)))
    z = h.rotated(u, 1, 0)
    assert np.allclose((z ** 2).sum(1), 1) and np.allclose(z @ z.T, u @ u.T)
    axes = h.axes(u)
    assert (h.signed(u, 1, 0).argmax(1) == axes[1, 0]).all()
    span = 16 * 16
    everything = h.probes(u, -9.0)
    assert all(sorted(p) == list(range(3 * span)) for p in everything)
    own = (h.coded(axes) + np.arange(3)[:, None] * span).T  # equal coordinates do happen: both axes are then probed
    assert all(set(o) <= set(p) and len(p) <= 6 for o, p in zip(own, h.probes(u, 9.0)))
    some = h.probes(u, 0.9)
    sums = [h.signed(u, 2, 0)[:, :, None] + h.signed(u, 2, 1)[:, None, :]]
    assert all(set(np.flatnonzero(sums[0][i].ravel() >= 0.9) + 2 * span) <= set(some[i]) for i in range(len(u)))
