"""Near-duplicate leakage, dense top-k, pessimistic labels, escalation windows, taxonomy fields."""

import json
import math
import random
from unittest import mock

import pytest
from pyspark.sql import functions as F

from caseweave import values as V
from caseweave.operators import dense, labels as L, leakage as LK, metrics as M
from caseweave.plans import bindings as T
from caseweave.sources import tables as S


def grams(text, k=5):
    w = text.lower().split()
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {" ".join(w)} - {""}


@pytest.mark.parametrize("contained", [False, True])
def test_near_duplicates_equal_brute_force(spark, contained):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    held = [(i, " ".join(rng.choices(words, k=rng.randint(3, 60)))) for i in range(25)] + [(90, "same words here"), (91, ""), (92, None)]
    pool = []
    for i, t in held[:25]:
        for edits in (0, 1, 2, 6):
            w = t.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(words)
            pool.append((1000 + len(pool), " ".join(w) + (" tail" * rng.randint(0, 30) if contained else "")))
    pool += [(5000, "Same  words HERE"), (5001, ""), (5002, None)] + [(6000 + i, "a shared line of many words " + t) for i, (_, t) in enumerate(held[:20])]
    got = {r["id"]: (r["held_id"], r["similarity"]) for r in LK.near_duplicates(
        spark.createDataFrame(pool, "id long, t string"), "id", "t", spark.createDataFrame(held, "h long, t string"), "h", "t",
        contained=contained).collect()}
    want = {}
    for i, t in pool:
        best = []
        for h, u in held:
            x, y = grams(t or ""), grams(u or "")
            if x and y:
                s = len(x & y) / (len(y) if contained else len(x | y))
                if s >= 0.8:
                    best.append((-s, h))
        if best:
            s, h = min(best)
            want[i] = (h, round(-s, 6))
    assert got == want


def test_dense_topk(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(m, 1) for _ in range(6)]) for m in (0, 5, -5) for i in range(100 * (m + 5), 100 * (m + 5) + 60)]
    rows += [(9000, None), (9001, [0.0] * 6), (9002, rows[0][1])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = [tuple(r) for r in dense.dense_topk(df, df.filter("id % 10 = 0"), "id", "v", 4, pivots=5).orderBy("query_id", "rank").collect()]
    unit = {i: [x / math.sqrt(sum(y * y for y in v)) for x in v] for i, v in rows if v and any(v)}
    want = []
    for q in sorted(i for i in unit if i % 10 == 0):
        best = sorted((-round(sum(a * b for a, b in zip(unit[q], v)), 6), i) for i, v in unit.items() if i != q)[:4]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want))
    assert dense.dense_topk(df.limit(0), df.limit(0), "id", "v").count() == 0


def test_dense_topk_every_20(spark):
    from caseweave.plans import registry as R

    folder = "/root/testdata/sf0.001"
    unit = {}
    for r in T.table(spark, folder, "embeddings").collect():
        length = math.sqrt(sum(float(x) * float(x) for x in r["embedding"]))
        unit[r["vec_id"]] = [float(x) / length for x in r["embedding"]]
    got = {}
    for r in R.queries()["dense_topk_every_20"](spark, folder).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["similarity"])
    assert set(got) == {i for i in unit if i % 20 == 0}
    for q, ranks in got.items():
        best = sorted((-round(sum(a * b for a, b in zip(unit[q], v)), 6), i) for i, v in unit.items() if i != q)[:5]
        assert [ranks[n][0] for n in range(1, 6)] == [i for _, i in best]
        assert all(abs(ranks[n][1] + s) < 2e-6 for n, (s, _) in enumerate(best, 1))


def test_dense_topk_deals_a_group_to_parts(spark):
    """One group of near vectors, under one join key before, is dealt to many parts, with the same answers."""
    rng = random.Random(3)
    df = spark.createDataFrame([(i, [rng.gauss(5, 1) for _ in range(6)]) for i in range(300)], "id long, v array<double>")
    asked = df.filter("id % 20 = 0")
    few, one = (dense.dense_topk(df, asked, "id", "v", 4, pivots=1, part_rows=n) for n in (10, 1000))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, one.collect())) and few.count() == 60


def test_dense_topk_tree(spark):
    """Clusters, copies and a tree of several levels give what comparing all pairs gives, and few groups are entered."""
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 12]]) for i in range(480)] + [(i, centres[0]) for i in range(480, 560)]
    rows += [(900, None), (901, []), (902, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    unit = {i: [x / math.sqrt(sum(y * y for y in v)) for x in v] for i, v in rows if v and any(v)}
    entered, whole = [], dense.block_scores

    def counted(asks, members, *more):
        entered.append(asks.join(members.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "group").agg(F.sum("n")).first()[0] or 0)
        return whole(asks, members, *more)

    with mock.patch.object(dense, "block_scores", counted):
        got = [tuple(r) for r in dense.dense_topk(df, df.filter("id % 20 = 0"), "id", "v", 4, pivots=4, part_rows=20).collect()]
    want = []
    for q in (i for i in unit if i % 20 == 0):
        best = sorted((-round(sum(a * b for a, b in zip(unit[q], v)), 6), i) for i, v in unit.items() if i != q)[:4]
        want += [(q, n, i) for n, (_, i) in enumerate(best, 1)]
    assert sorted(g[:3] for g in got) == sorted(want)
    assert sum(entered) < 0.5 * len(unit) * len(want) / 4


def test_pessimistic_labels(spark):
    taxonomy = T.taxonomy(spark)
    df = spark.createDataFrame([(1, "thing erin"), (2, "thing than"), (3, "none"), (4, None)], "id long, t string")
    got = {r["id"]: (r["risk_level"], r["decision"]) for r in L.multi_label_pessimistic(df, "t", taxonomy, T.KEYWORDS).collect()}
    assert got == {1: ("low", V.AUTO), 2: ("high", V.ESCALATE), 3: ("medium", V.ESCALATE), 4: ("medium", V.ESCALATE)}


def test_escalation_windows(spark):
    rows = [("2024-01-01 00:10:00", True), ("2024-01-01 00:50:00", False), ("2024-01-01 01:00:00", None), (None, True)]
    df = spark.createDataFrame(rows, "at string, hit boolean").withColumn("at", F.to_timestamp("at"))
    got = [(r["n"], r["n_escalated"], r["escalation_rate"]) for r in M.escalation_windows(df, "at", "hit").orderBy("window_start").collect()]
    assert got == [(2, 1, 0.5), (1, 1, 1.0)]


def test_taxonomy_has_all_fields(spark, tmp_path):
    item = {"name": "a", "display_name": "A", "description": "what it is", "risk_level": "high", "default_action": "ESCALATE_TO_HUMAN",
            "examples": ["x"], "resolution_patterns": ["do y"], "escalation_conditions": ["if z"]}
    (tmp_path / "t.json").write_text(json.dumps({"intents": [item, {"name": "b"}]}, indent=1))
    a, b = S.read_taxonomy(spark, str(tmp_path / "t.json")).orderBy("priority").collect()
    assert {k: a[k] for k in item} == item
    assert (b["risk_level"], b["default_action"], b["examples"], b["resolution_patterns"]) == ("low", "AUTO_HANDLE", [], [])
