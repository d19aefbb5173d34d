from pyspark.sql import functions as F

from caseweave import values as V
from caseweave.operators import failures as FM, judge as J, metrics as M, profile as P


def pairs(spark, rows):
    return spark.createDataFrame(rows, "t string, p string")


def test_classification_metrics(spark):
    df = pairs(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("a", "d")])
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in M.per_class_prf(df, "t", "p").collect()}
    assert got == {"a": (1.0, 0.3333, 0.5, 3), "b": (0.3333, 1.0, 0.5, 1), "c": (0.0, 0.0, 0.0, 1), "d": (0.0, 0.0, 0.0, 0)}
    (m,) = M.macro_prf(df, "t", "p").collect()
    assert (m.macro_precision, m.macro_recall, m.macro_f1) == (0.3333, 0.3333, 0.25)
    assert M.accuracy(df, "t", "p").first()[0] == 0.4
    matrix = {(r.truth, r.predicted): r.n for r in M.confusion_matrix(df, "t", "p").collect()}
    assert len(matrix) == 16 and matrix[("a", "b")] == 1 and matrix[("d", "d")] == 0 and sum(matrix.values()) == 5


def test_safety_edges(spark):
    none = pairs(spark, [])
    assert M.escalation_safety(none, "t", "p").count() == 0
    (r,) = M.escalation_safety(pairs(spark, [(V.AUTO, V.ESCALATE)]), "t", "p").collect()
    assert (r.automation_coverage, r.auto_handle_precision, r.false_auto_rate, r.escalation_recall) == (0, 0, 0, 0)
    assert r.unnecessary_escalations == 1
    (r,) = M.escalation_safety(pairs(spark, [(V.AUTO, V.AUTO), (V.ESCALATE, V.AUTO), (V.ESCALATE, V.ESCALATE)]), "t", "p").collect()
    assert (r.automation_coverage, r.auto_handle_precision, r.false_auto_rate, r.escalation_recall) == (0.6667, 0.5, 0.5, 0.5)


def test_retrieval_metrics(spark):
    queries = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a")], "q long, gold string")
    results = spark.createDataFrame([
        (1, 1, "a", 0.9, "a"), (2, 1, "b", 0.2, "a"), (2, 2, "a", 0.1, "a"), (3, 1, "b", 0.5, "a"), (3, 2, "b", 0.1, "a")],
        "q long, rank int, case_intent string, similarity_score double, gold string")
    (r,) = M.retrieval_metrics(M.first_relevant(queries, results, "q", "gold")).collect()
    assert (r.recall_at_1, r.recall_at_3, r.recall_at_5, r.mrr) == (0.5, 0.75, 0.75, 0.625)
    assert r.mean_top1_similarity == round((0.9 + 0.2 + 0.5) / 3, 4)


def test_judge(spark):
    rows = [("my battery", "Please DM us, check Settings > Battery", 0.72), ("hi", "", 0.9), ("hi", None, 0.9),
            ("hi", "we guarantee it", 0.1), ("hi", "send a direct message", 0.56), ("hi", "hmm", 0.4)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, customer_message string, reply string, top_similarity double")
    got = sorted(J.judge_scores(df).collect(), key=lambda r: r.i)
    first = got[0]
    assert (first.correctness, first.groundedness, first.helpfulness, first.unsupported_claims, first.tone) == (4.5, 5.0, 4.5, 5.0, 4.5)
    assert first.verdict == "PASS" and first.overall_score == 4.7
    assert first.feedback == "Grounded in evidence (sim: 0.72). Tone: 4.5/5. No unauthorized promises."
    for blank in got[1:3]:
        assert (blank.overall_score, blank.verdict, blank.feedback) == (1.0, "FAIL", "Empty or missing response.")
    assert got[3].unsupported_claims == 1.0 and got[3].verdict == "FAIL"
    assert (got[4].groundedness, got[4].helpfulness, got[4].correctness) == (4.0, 4.0, 4.5)
    assert (got[5].groundedness, got[5].helpfulness, got[5].correctness, got[5].tone) == (3.0, 3.0, 3.5, 3.0)
    (s,) = J.judge_summary(J.judge_scores(df)).collect()
    assert s.total_evaluated == 6 and s.pass_rate == round(3 / 6 * 100, 2)


def test_agreement(spark):
    rows = [(1, 1.0, 1.0), (2, 2.0, 2.0), (3, 2.0, 3.0), (4, 4.0, 3.0), (5, 5.0, 4.0)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    import pandas as pd

    pdf = pd.DataFrame(rows, columns=["i", "a", "b"])
    (r,) = J.correlations(df, "a", "b").collect()
    assert r.pearson_correlation_r == round(pdf.a.corr(pdf.b), 4)
    assert r.spearman_correlation_rho == round(pdf.a.rank().corr(pdf.b.rank()), 4)
    flat = J.correlations(df.withColumn("b", F.lit(3.0)), "a", "b").first()
    assert tuple(flat) == (None, None)
    kappa = spark.createDataFrame([("PASS", "PASS"), ("PASS", "FAIL"), ("FAIL", "FAIL"), ("FAIL", "FAIL")], "a string, b string")
    assert J.cohen_kappa(kappa, "a", "b").first()[0] == 0.5
    same = spark.createDataFrame([("PASS", "PASS")], "a string, b string")
    assert J.cohen_kappa(same, "a", "b").first()[0] is None
    scores = spark.createDataFrame([(i, 3.0 + i / 10, 5.0, "PASS") for i in range(10)],
                                   "i int, overall_score double, unsupported_claims double, verdict string")
    assert J.agreement_sample(scores, "i", 50).count() == 10 and J.agreement_sample(scores, "i", 4).count() == 4
    rated = scores.withColumns({"human_score": F.col("overall_score") + 0.25, "human_verdict": F.lit("FAIL")})
    (a,) = J.rater_agreement(rated).collect()
    assert a.sample_size == 10 and a.mean_absolute_error == 0.25 and a.verdict_agreement_percentage == 0
    assert a.spearman_correlation_rho == 1.0


def test_spearman_uses_the_values_as_they_are(spark):
    rows = [(1.001, 1.0), (1.002, 3.0), (1.003, 2.0), (1.004, 4.0), (None, 9.0), (2.0, float("nan"))]
    got = J.correlations(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()
    assert got["spearman_correlation_rho"] == 0.8
    many = spark.createDataFrame([(float(i), float(i // 3)) for i in range(3000)], "a double, b double").repartition(5)
    ranks = {r["a"]: r["r"] for r in J.average_ranks(many, "b", "r").collect()}
    assert ranks[0.0] == ranks[2.0] == 2.0 and ranks[2999.0] == 2999.0


def test_failure_modes(spark):
    rows = [("g1", "this and that", "a", "b", V.AUTO, V.AUTO, 0.9, False),
            ("g2", "help me", "a", "a", V.AUTO, V.ESCALATE, 0.9, False),
            ("g3", "black screen", "a", "a", V.ESCALATE, V.ESCALATE, 0.9, False),
            ("g4", "long enough text to pass", "a", "a", V.AUTO, V.AUTO, 0.49, False),
            ("g5", "charged on old id today", "app_store_billing_subscription", "a", V.ESCALATE, V.ESCALATE, 0.9, True),
            ("g6", "one and two", "a", "b", V.AUTO, V.AUTO, 0.9, False)]
    df = spark.createDataFrame(rows, "id string, customer_message string, gold_intent string, predicted_intent string, "
                                     "gold_decision string, decision string, grounding_score double, is_ambiguous boolean")
    got = {r["mode"]: r.real_example for r in FM.failure_modes(df).collect()}
    assert got == {1: "this and that", 2: "help me", 3: "black screen", 4: "long enough text to pass", 5: "charged on old id today"}
    assert FM.failure_modes(df.filter("id = 'g3'")).count() == 1


def test_profile(spark):
    rows = [(1, "u", True, "Tue Oct 31 22:08:27 +0000 2017", "@One Hello hello World @x abc", None, None),
            (2, "One", False, "Wed Nov 01 22:08:27 +0000 2017", "please DM us", "1", 1.0),
            (3, "One", False, "broken", "no", None, 1.0), (4, "v", True, None, None, None, None)]
    df = spark.createDataFrame(rows, "tweet_id long, author_id string, inbound boolean, created_at string, text string, "
                                     "response_tweet_id string, in_response_to_tweet_id double")
    assert {r.column_name: r.nulls for r in P.null_counts(df).collect()}["text"] == 1
    assert P.direction_counts(df).first().inbound_ratio == 0.5
    assert P.direction_counts(df.limit(0)).first().inbound_ratio == 0.0
    (d,) = P.date_range(df).select(F.col("first_at").cast("string"), F.col("last_at").cast("string")).collect()
    assert (d[0][:10], d[1][:10]) == ("2017-10-31", "2017-11-01")
    (t,) = P.text_statistics(df).collect()
    assert (t.char_length_min, t.char_length_max, t.word_count_median) == (2, 29, 3.0)
    (b,) = P.brand_ranking(df).collect()
    assert (b.brand, b.total_messages, b.resolution_rich_replies, b.estimated_conversations) == ("One", 3, 1, 1)
    assert (b.customer_vocabulary_diversity, b.sample_customer_issues) == (2, ["@One Hello hello World @x abc"])
    assert b.suitability_score == round(3 / 60000 * 30 + 1 / 25000 * 30 + 2 / 4000 * 20 + 1 / 15000 * 20, 2)


def test_ratings_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def rated(i):
        read.add(1)
        return float(i), "PASS", i / 2, "FAIL"

    schema = "human_score double, human_verdict string, overall_score double, verdict string"
    (a,) = J.rater_agreement(spark.createDataFrame(spark.sparkContext.parallelize(range(20), 2).map(rated), schema)).collect()
    assert a.sample_size == 20 and a.spearman_correlation_rho == 1.0 and read.value == 20


def test_document_ratings_move_no_text(spark, tmp_path):
    from caseweave.plans import registry

    spark.createDataFrame([(1, "two words", 9), (1, None, 9), (2, "x", 1)], "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (1, 0), (3, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rated = registry.document_ratings(spark, str(tmp_path))
    assert sorted((r["human_score"], r["human_verdict"]) for r in rated.collect()) == [(0.0, "FAIL"), (0.0, "PASS"), (2.0, "FAIL"), (2.0, "PASS")]
    assert "text#" not in rated._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
