"""Near duplicates: only shingles of both sides travel, and the words of a text are cut once."""

from unittest import mock

from caseweave.operators import leakage as LK


def test_shingles_of_one_side_are_left_out(spark):
    pool = spark.createDataFrame([(i, " ".join(f"p{i}x{j}" for j in range(30))) for i in range(4)] + [(9, "a b c d e f g h")] * 2, "i long, t string")
    held = spark.createDataFrame([(1, "a b c d e f g h"), (2, "q r s t u v")], "h long, u string")
    kept, whole = {}, LK.materialize

    def noted(df, name):
        kept[name] = whole(df, name)
        return kept[name]

    with mock.patch.object(LK, "materialize", noted):
        for contained in (False, True):
            got = LK.near_duplicates(pool, "i", "t", held, "h", "u", contained=contained).collect()
            assert [(r.i, r.held_id, r.similarity) for r in got] == [(9, 1, 1.0)] * 2
            assert kept["met"].count() == 4  # four runs of five words, once for both copies


def test_words_are_cut_once(spark):
    plans, whole = [], LK.materialize

    def noted(df, name):
        if name == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, name)

    rows = spark.createDataFrame([(1, "a b c d e f")], "i long, t string")
    with mock.patch.object(LK, "materialize", noted):
        assert LK.near_duplicates(rows, "i", "t", rows, "i", "t").count() == 1
    assert plans and all(p.count("split(") <= 2 for p in plans)  # one more for the filter on empty texts
