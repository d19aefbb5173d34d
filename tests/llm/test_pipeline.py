import corpus_pipeline
from caseweave.llm import hostrules, mixing, omh, secrets
from test_omh import brute_classes
from test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_steps(spark, given):
    docs = given("documents")
    kept = {r["doc_id"] for r in hostrules.judge(docs).filter("kept").collect()}
    one = brute_classes([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept])
    want = {i for i, c in one.items() if i == c}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, "")
        assert seen.columns == docs.columns, name
        if name == "near-dedup":
            assert {r["doc_id"] for r in seen.collect()} == want
        if name == "secret scans":
            assert secrets.scan(seen).filter("n_assign + n_access + n_hex > 0").count() == 0
    mixed = seen.cache()
    assert {r["doc_id"] for r in mixed.collect()} == want  # every document at least once
    assert mixed.groupBy("doc_id").count().filter("count > 2").count() == 0
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    first = pieces.drop_duplicates(["doc_id", "start", "length"])
    assert set(pieces.doc_id) == want
    again = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert (pieces.groupby("doc_id").length.sum() == first.groupby("doc_id").doc_tokens.first() * pieces.doc_id.drop_duplicates().set_axis(
        pieces.doc_id.drop_duplicates()).map(again).sort_index()).all()
    once = pieces[pieces.doc_id.map(again) == 1]
    assert set(once.doc_id) and texts
    check(once.assign(sequence_id=range(len(once)), offset=0), texts)


def test_empty_table(spark, docs):
    empty = docs([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0
