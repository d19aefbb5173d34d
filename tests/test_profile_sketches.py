import random

from pyspark.sql import functions as F

from caseweave.operators import profile as P, profile_sketches as S


def messages(spark, n=4000):
    rng = random.Random(5)
    rows = [(f"2024-01-{1 + i % 9:02}", f"b{i % 3}", " ".join(f"word{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return spark.createDataFrame(rows + [("2024-01-02", "b0", None), (None, "b1", "no day here")], "at string, brand string, text string")


def test_days_merge_to_the_exact_profile(spark, tmp_path):
    df, path = messages(spark), str(tmp_path / "days")
    S.write_days(S.text_sketches(df, "at"), path)
    got, want = S.text_statistics(S.read_days(spark, path)).first(), P.text_statistics(df).first()
    for c in ("char_length_mean", "char_length_min", "char_length_max", "word_count_mean"):
        assert got[c] == want[c]
    sizes = sorted(len(r["text"]) for r in df.collect() if r["text"] is not None)
    assert got["n"] == len(sizes)
    low, high = (sum(x < got["char_length_median"] for x in sizes) / len(sizes), sum(x <= got["char_length_median"] for x in sizes) / len(sizes))
    assert low <= 0.5 + S.RANK_ERROR and high >= 0.5 - S.RANK_ERROR
    S.write_days(S.vocabulary_sketches(df, "at"), str(tmp_path / "words"))
    sketched = {r[0]: r[1] for r in S.vocabulary_diversity(S.read_days(spark, str(tmp_path / "words"))).collect()}
    exact = {r[0]: r[1] for r in P.vocabulary_diversity(df).collect()}
    assert set(sketched) == set(exact) and all(abs(sketched[b] - exact[b]) <= S.SIZE_ERROR * exact[b] for b in exact)


def test_a_day_run_again_replaces_its_row_only(spark, tmp_path):
    df, path = messages(spark, 300), str(tmp_path / "days")
    S.write_days(S.text_sketches(df, "at"), path)
    S.write_days(S.text_sketches(df.filter("at = '2024-01-03'").withColumn("text", F.lit("four")), "at"), path)
    rows = {str(r["day"]): r["n"] for r in S.read_days(spark, path).collect()}
    assert len(rows) == 10 and S.read_days(spark, path, "2024-01-03", "2024-01-03").first()["chars_max"] == 4
    assert S.text_statistics(S.read_days(spark, path, "2024-01-03", "2024-01-04")).first()["n"] == rows["2024-01-03"] + rows["2024-01-04"]
    empty = S.text_statistics(S.read_days(spark, path, "2025-01-01")).first()
    assert empty["n"] == 0 and empty["char_length_median"] is None
