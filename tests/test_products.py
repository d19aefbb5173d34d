"""The search by products of parts gives what the search by joins and brute force give, without a row for a posting that is met."""

import random

import pytest

from caseweave.operators import retrieve as R
from test_retrieve import ask, brute_force, build


def texts():
    random.seed(7)
    words = ["the"] * 6 + [f"w{i}" for i in range(40)]
    issues = [" ".join(random.choices(words, k=random.randint(1, 12))) for _ in range(300)] + ["same words"] * 100
    queries = [" ".join(random.choices([*words, "unseen"], k=random.randint(1, 8))) for _ in range(80)] + ["same", "unseen", "", "same words"]
    return issues, queries


@pytest.mark.parametrize("part_cases,part_queries,cells", [(16_384, 65_536, 2_000_000), (70, 30, 1000)])
def test_products_equal_brute_force(spark, monkeypatch, part_cases, part_queries, cells):
    issues, queries = texts()
    intents = [random.choice(["a", "b", None]) for _ in issues]
    index = build(spark, issues, intents)
    df = spark.createDataFrame([(i, q, random.choice(["a", "b", "zz", "", None])) for i, q in enumerate(queries)], "q long, text string, want string")
    rows = lambda: sorted((r.q, r.rank, r.case_order, round(r.similarity, 6)) for r in R.top_cases(df, index, "q", "text", 4, intent="want").collect())
    by_joins, whole = rows(), R.products
    monkeypatch.setattr(R, "JOIN_ENTRIES", -1)
    monkeypatch.setattr(R, "CELLS", cells)
    monkeypatch.setattr(R, "products", lambda t, i, q, k: whole(t, i, q, k, part_cases, part_queries))
    monkeypatch.setattr(R, "scores", None)  # no row for each posting entry
    assert rows() == by_joins
    got = ask(spark, queries, index, k=4)
    assert all(got[i] == brute_force(issues, q, 4) for i, q in enumerate(queries) if q)


def test_many_entries_are_met_by_products(spark, monkeypatch):
    issues, queries = texts()
    index = build(spark, issues)
    monkeypatch.setattr(R, "JOIN_ENTRIES", 1000)
    monkeypatch.setattr(R, "scores", None)
    assert ask(spark, queries, index, k=2)[83][0] == (300, 1.0)


def test_large_idf_table_is_not_repeated(spark):
    """Beyond the size of a broadcast each term moves once."""
    from caseweave.operators.features import raw_weights

    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1), (3, None, 1)], "d long, term string, tf long")
    idf = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "term string, idf double")
    got = raw_weights(counts, idf, "left", small=False)
    assert "Generate" not in got._jdf.queryExecution().toString() and got.count() == 4 and got.filter("raw is not null").count() == 2


def test_products_need_no_postings(spark, monkeypatch):
    """An index in use for products alone never has its postings made; a search by joins makes them once."""
    issues, queries = texts()
    index = build(spark, issues[:60])
    monkeypatch.setattr(R, "JOIN_ENTRIES", -1)
    want = ask(spark, queries[:10], index, k=2)
    assert index.blocks is None
    monkeypatch.setattr(R, "JOIN_ENTRIES", 10 ** 9)
    assert ask(spark, queries[:10], index, k=2) == want
    assert index.blocks is not None and index.postings is index.postings


def test_query_vectors_count_the_entries_they_meet(spark):
    """One row a query, without texts of terms; `met` is the sum of the frequencies of its terms in the cases."""
    index = build(spark, ["red car", "red bus", "blue bus stop"])
    df = spark.createDataFrame([(1, "red bus"), (2, "unseen"), (3, "blue blue")], "q long, text string")
    asked = R.wanted_intents(df, index, "q", None)
    rows = {r.q: r for r in R.query_vectors(df, index, "q", "text", asked).collect()}
    assert {q: r.met for q, r in rows.items()} == {1: 5, 3: 1}  # red 2, bus 2, red bus 1; blue 1
    assert all(abs(sum(w * w for w in r.weights) - 1) < 1e-12 and len(r.numbers) == len(r.weights) for r in rows.values())
