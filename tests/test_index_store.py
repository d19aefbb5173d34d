import random

import pytest
from test_retrieve import CASES, ask

from caseweave.operators import index_store as S, retrieve as R


@pytest.fixture
def texts():
    rng = random.Random(9)
    words = ["the"] * 4 + [f"w{i}" for i in range(30)]
    return lambda n: [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, f"c{i}", t, f"answer {i}", t, "x", 2) for i, t in rows], CASES)


def test_append_delete_compact_equal_a_rebuild(spark, tmp_path, texts):
    path, queries = str(tmp_path / "index"), texts(12)
    kept = dict(enumerate(texts(60)))
    assert S.append_cases(frame(spark, kept.items()), path) == 1
    assert ask(spark, queries, S.open_index(spark, path), k=4) == ask(spark, queries, R.build_index(frame(spark, kept.items())), k=4)
    more = {**dict(zip(range(100, 130), texts(30))), 5: "w1 w2 replaced", 6: ""}
    S.append_cases(frame(spark, more.items()), path)
    S.delete_cases(spark.createDataFrame([(7,), (100,), (999,)], "case_order long"), path)
    S.append_cases(frame(spark, [(7, "w3 back again")]), path)
    want = {**kept, **more, 7: "w3 back again"}
    del want[100]
    whole = R.build_index(frame(spark, want.items()))
    opened = S.open_index(spark, path)
    rows = lambda t: sorted((r["case_order"], r["term"], round(r["weight"], 9)) for r in R.postings_long(t).collect())
    assert rows(opened) == rows(whole) and ask(spark, queries, opened, k=4) == ask(spark, queries, whole, k=4)
    assert S.is_current(frame(spark, want.items()), path) and not S.is_current(frame(spark, kept.items()), path)
    assert S.compact(spark, path) == 5
    S.delete_cases(spark.createDataFrame([(8,)], "case_order long"), path)
    del want[8]
    assert rows(S.open_index(spark, path)) == rows(R.build_index(frame(spark, want.items())))
    assert [r["kind"] for r in S.generations(spark, path)] == ["append", "append", "delete", "append", "compact", "delete"]


def test_refresh_takes_over_only_what_changed(spark, tmp_path, texts):
    path = str(tmp_path / "index")
    cases = dict(enumerate(texts(40)))
    S.refresh(frame(spark, cases.items()), path)
    assert len(S.generations(spark, path)) == 1
    S.refresh(frame(spark, cases.items()), path)
    assert len(S.generations(spark, path)) == 1  # nothing changed, nothing written
    cases[3], cases[50] = "w5 w6 changed", "w7 new"
    del cases[4]
    opened = S.refresh(frame(spark, cases.items()), path)
    last = S.generations(spark, path)
    assert [r["kind"] for r in last] == ["append", "append", "delete"]
    assert sorted(r[0] for r in spark.read.parquet(f"{path}/{last[1]['folder']}/cases").select("case_order").collect()) == [3, 50]
    assert {r["case_order"]: r["customer_issue"] for r in opened.cases.collect()} == cases


def test_nothing_appended(spark, tmp_path):
    assert S.generations(spark, str(tmp_path)) == []
    with pytest.raises(ValueError):
        S.open_index(spark, str(tmp_path))
