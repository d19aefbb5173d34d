"""Terms of a whole corpus, counted and weighted by parts, against the plain tables of counts."""

import pytest

from caseweave.operators import features as FE
from caseweave.plans import registry as R

ROWS = [(1, "the cat sat on the mat the cat"), (1, "the cat again"), (2, "Été déjà vu the CAT"), (3, None), (4, ""), (5, "--- !"), (None, "the lone cat"),
        (None, "the other one"), (6, "x"), (6, "x"), (7, "don't you don't"), *[(n, f"word{n} the cat word{n % 5}") for n in range(8, 60)]]
WAYS = [FE.Analyzer("word", 1, 2), FE.Analyzer("word", 2, 3), FE.Analyzer("char_wb", 3, 4, False), FE.Analyzer("word", 1, 2, True, r"[a-z]+(?: cat)?")]


@pytest.mark.parametrize("least", [1, 1 << 20])  # many parts and one
@pytest.mark.parametrize("analyzer", WAYS)
def test_parts_give_the_rows_of_the_counts(spark, monkeypatch, analyzer, least):
    monkeypatch.setattr(FE, "LEAST_BYTES", least)
    df = spark.createDataFrame(ROWS, "id long, text string")
    counts = FE.term_counts(df, "id", "text", analyzer)
    assert sorted(FE.corpus_vocabulary(df, "id", "text", analyzer).collect()) == sorted(FE.vocabulary(counts, None).collect())
    table = FE.idf(FE.vocabulary(counts, None), len(ROWS)).select("term", "idf")
    key = lambda r: (r.id is None, r.id, r.term)
    want = sorted(FE.tfidf_weights(counts, table, "id").collect(), key=key)
    got = sorted(FE.corpus_weights(df, "id", "text", analyzer, len(ROWS)).collect(), key=key)
    assert list(map(key, got)) == list(map(key, want))
    assert [r.weight for r in got] == pytest.approx([r.weight for r in want])


def test_no_rows_and_no_terms(spark):
    for rows in ([], [(1, None), (2, " ")]):
        df = spark.createDataFrame(rows, "id long, text string")
        assert FE.corpus_vocabulary(df, "id", "text", FE.Analyzer()).count() == 0
        assert FE.corpus_weights(df, "id", "text", FE.Analyzer(), len(rows)).count() == 0


def test_weights_write_no_counts_and_no_row_for_an_occurrence_moves(spark, monkeypatch, tmp_path):
    """the counts of all documents were written, moved by term and moved by document."""
    rows = [(n, "each text has these same words") for n in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def refuse(*_):
        raise AssertionError("the counts are written")

    monkeypatch.setattr(R, "materialize", refuse)
    assert R.tfidf_weights(spark, str(tmp_path)).count() == 200 * 11
    tokens, _, sizes = FE.dealt(spark.read.parquet(f"{tmp_path}/documents.parquet"), "doc_id", "text", R.DOC_WORDS)
    parts = FE.term_parts(tokens, *sizes)
    assert parts.count() == 11 and {r.df for r in parts.collect()} == {200}


def test_vocabulary_counts_by_parts(spark, monkeypatch, tmp_path):
    """every n-gram of every document went through two aggregations."""
    spark.createDataFrame([(1, "a b a"), (2, "b a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(FE, "term_counts", None)
    assert {(r.term, r.df) for r in R.idf(spark, str(tmp_path)).collect()} == {("a", 2), ("b", 2), ("a b", 1), ("b a", 2)}
    assert {(r.term, r.n) for r in R.vocabulary_top(spark, str(tmp_path)).collect()} == {("a", 3), ("b", 2), ("a b", 1), ("b a", 2)}
