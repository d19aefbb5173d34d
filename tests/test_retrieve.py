import math
import random
from collections import Counter

import pytest

from caseweave.operators import draft as I, retrieve as R

CASES = "case_order long, case_id string, customer_issue string, brand_resolution string, conversation_context string, " \
        "intent string, turn_count long"


def build(spark, issues, intents=None, **options):
    rows = [(i, f"c{i}", t, f"answer {i}", t, intents[i] if intents else "x", 2) for i, t in enumerate(issues)]
    return R.build_index(spark.createDataFrame(rows, CASES), **options)


def ask(spark, queries, index, **options):
    df = spark.createDataFrame(list(enumerate(queries)), "q long, text string")
    out = {}
    for r in R.top_cases(df, index, "q", "text", **options).orderBy("q", "rank").collect():
        out.setdefault(r.q, []).append((r.case_order, round(r.similarity, 6)))
    return out


def grams(text):
    t = text.lower().split()
    return [" ".join(t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)]


def brute_force(issues, query, k):
    df = Counter(g for t in issues for g in set(grams(t)))
    weight = {g: math.log((1 + len(issues)) / (1 + n)) + 1 for g, n in df.items()}

    def vector(text):
        v = {g: (1 + math.log(n)) * weight[g] for g, n in Counter(grams(text)).items() if g in weight}
        length = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / length for g, x in v.items()}

    qv = vector(query)
    scores = [(sum(x * qv.get(g, 0.0) for g, x in vector(t).items()), i) for i, t in enumerate(issues)]
    return [(i, round(s, 6)) for s, i in sorted(scores, key=lambda p: (-round(p[0], 6), p[1]))[:k]]


@pytest.mark.parametrize("slot,probe", [(1000, 1000), (7, 30), (3, 0)])
def test_equals_brute_force(spark, slot, probe):
    random.seed(3)
    words = ["the"] * 6 + [f"w{i}" for i in range(25)]
    issues = [" ".join(random.choices(words, k=random.randint(1, 8))) for _ in range(40)]
    queries = [" ".join(random.choices(words + ["unseen"], k=random.randint(1, 6))) for _ in range(25)]
    index = build(spark, issues, slot=slot)
    got = ask(spark, queries, index, k=4, probe=probe)
    assert got == {i: brute_force(issues, q, 4) for i, q in enumerate(queries)}


def test_more_cases_and_terms_than_any_cap(spark):
    from pyspark.sql import functions as F

    n = 46_000
    cases = spark.range(n).select(
        F.col("id").alias("case_order"), F.concat(F.lit("c"), "id").alias("case_id"),
        F.concat(F.lit("the common words own"), "id").alias("customer_issue"), F.lit("a").alias("brand_resolution"),
        F.lit("ctx").alias("conversation_context"), F.lit("x").alias("intent"), F.lit(2).cast("long").alias("turn_count"))
    index = R.build_index(cases)
    assert index.cases.count() == n and index.idf.count() > n
    got = ask(spark, [f"the own{n - 1} common words", "own7"], index, k=1)
    assert got[0][0][0] == n - 1 and got[1][0][0] == 7
    plan = R.top_cases(spark.createDataFrame([(1, "own5")], "q long, text string"), index, "q", "text")._jdf.queryExecution().toString()
    assert "CoGroup" not in plan and "CartesianProduct" not in plan


def test_top_case(spark):
    index = build(spark, ["lamp flickers in the hall", "door squeaks at night"])
    df = spark.createDataFrame([(1, "hall lamp is dim")], "q long, text string")
    (r,) = R.search_topk(df, index, "q", "text", 1).collect()
    assert (r.case_id, r.rank, r.brand_resolution) == ("c0", 1, "answer 0") and r.similarity_score > 0


def test_blank_unknown_ties_and_few_cases(spark):
    index = build(spark, ["same words", "same words"])
    got = ask(spark, ["", "  ", "unknown", "!!!", "same"], index, k=3)
    assert set(got) == {2, 3, 4}                       # blank queries have no rows
    assert got[2] == got[3] == [(0, 0.0), (1, 0.0)]    # nothing in common: filled in case order
    assert [c for c, _ in got[4]] == [0, 1]            # ties stay in case order


def test_intent_filter(spark):
    index = build(spark, ["red car", "red bus", "red van"], ["a", "b", "b"])
    df = spark.createDataFrame([(1, "red car", "b"), (2, "red car", "zzz"), (3, "red car", None)],
                               "q long, text string, want string")
    rows = R.top_cases(df, index, "q", "text", 3, intent="want").orderBy("q", "rank").collect()
    by = {q: [r.case_order for r in rows if r.q == q] for q in (1, 2, 3)}
    assert by == {1: [1, 2], 2: [0, 1, 2], 3: [0, 1, 2]}
    open_index = build(spark, ["red car", "red bus", "red van"], ["a", "b", None])
    rows = R.top_cases(df, open_index, "q", "text", 3, intent="want").orderBy("q", "rank").collect()
    by = {q: [r.case_order for r in rows if r.q == q] for q in (1, 2, 3)}
    assert by == {1: [1, 2], 2: [2], 3: [0, 1, 2]}


def test_floor_applies_after_the_cut(spark):
    index = build(spark, ["red car", "blue bus", "green van"])
    assert [c for c, _ in ask(spark, ["red car"], index, k=3, min_similarity=0.5)[0]] == [0]
    assert ask(spark, ["red car"], index, k=3, min_similarity=1.1) == {}


def test_save_and_load(spark, tmp_path):
    path = str(tmp_path / "index")
    calls = []

    def cases():
        calls.append(1)
        return spark.createDataFrame([(1, "c1", "red car", "a", "red car", "x", 2)], CASES)

    R.load_or_build_index(spark, path, cases)
    again = R.load_or_build_index(spark, path, cases)
    assert len(calls) == 1 and ask(spark, ["red"], again, k=1)[0][0][0] == 1


def test_empty_index(spark):
    index = R.build_index(spark.createDataFrame([], CASES))
    assert ask(spark, ["hello"], index) == {}


def test_build_cases(spark):
    rows = [(1, "conv_1", "my battery dies", "try this now", 2), (2, "conv_2", "held out text", "try this now", 2),
            (3, "conv_3", "too short", "try this now", 2), (4, "conv_4", "a b c", "too short", 2),
            (5, "conv_5", "nothing special here", "try this now", 3)]
    threads = spark.createDataFrame(rows, "root_tweet_id long, conversation_id string, customer_cleaned_issue string, "
                                          "brand_first_response string, turn_count long")
    held = spark.createDataFrame([("conv_2",)], "conversation_id string")
    got = R.build_cases(threads, held).orderBy("case_order").collect()
    assert [(r.case_id, r.intent) for r in got] == [
        ("conv_1", "battery_power_drain"), ("conv_5", "general_inquiry_advice")]
    assert [r.case_id for r in R.build_cases(threads, held, max_cases=1).collect()] == ["conv_1"]


EVIDENCE = "array<struct<rank:int,case_id:string,similarity_score:double,customer_issue:string,brand_resolution:string," \
           "conversation_context:string,intent:string>>"


def test_draft(spark):
    def e(rank, sim, reply):
        return (rank, f"c{rank}", sim, "issue " * 20, reply, "ctx", "x")

    rows = [(1, [e(1, 0.75, "  Check Settings. "), e(2, 0.5, "b"), e(3, 0.1, "c")]), (2, None), (3, [e(1, 0.9, "  ")]),
            (4, [e(1, 0.9, "We GUARANTEE a fix")]), (5, [e(1, 0.4, "ok")]), (6, [e(1, 0.3999, "ok")])]
    got = {r.q: r for r in I.draft_reply(spark.createDataFrame(rows, f"q long, evidence {EVIDENCE}")).collect()}
    assert got[1].reply == "Check Settings." and got[1].evidence_ids == ["c1", "c2"] and got[1].is_grounded
    assert got[1].evidence_summary == "Grounded in case c1 (sim: 0.75): '" + ("issue " * 20)[:60] + "...'"
    assert (got[2].grounding_score, got[2].is_grounded, got[2].generation_method) == (0.0, False, "fallback_no_evidence")
    assert got[2].evidence_ids == [] and got[2].reply.startswith("We want to help")
    assert got[3].reply.startswith("We'd like to help")
    assert got[4].unsupported_claims_detected and not got[4].is_grounded
    assert got[5].is_grounded and not got[6].is_grounded


def test_prompts(spark):
    rows = [(1, "m", "i", [(1, "c1", 0.756, "issue", "reply", "ctx", "x")], "earlier"), (2, "m", "i", None, "")]
    df = spark.createDataFrame(rows, f"q long, message string, intent string, evidence {EVIDENCE}, ctx string")
    a, b = [r.prompt for r in I.grounding_prompts(df, "message", "intent", context="ctx").orderBy("q").collect()]
    assert a.startswith('CUSTOMER INQUIRY:\n"m"\n\nCLASSIFIED INTENT: i\n\nCONVERSATION CONTEXT:\nearlier\n')
    assert "--- Evidence Case [c1] (Relevance Score: 0.76) ---\nCustomer Issue: issue\nHistorical Support Resolution: reply" in a
    assert "Single-turn inquiry." in b and "No historical evidence available." in b and '"reply": "<your' in b


@pytest.mark.parametrize("slot,fan,probe", [(2, 2, 1), (3, 4, 2)])
def test_levels_of_blocks(spark, slot, fan, probe):
    """Blocks of blocks bound the same answers, also by intent."""
    random.seed(5)
    words = ["the"] * 4 + [f"w{i}" for i in range(12)]
    issues = [" ".join(random.choices(words, k=random.randint(1, 9))) for _ in range(70)]
    queries = [" ".join(random.choices(words + ["unseen"], k=random.randint(1, 6))) for _ in range(20)]
    intents = [random.choice(["a", "b", None]) for _ in issues]
    index = build(spark, issues, intents, slot=slot, fan=fan)
    assert len(index.upper) >= 2
    assert ask(spark, queries, index, k=4, probe=probe) == {i: brute_force(issues, q, 4) for i, q in enumerate(queries)}
    df = spark.createDataFrame([(i, q, "b") for i, q in enumerate(queries)], "q long, text string, want string")
    of_b = [i for i, x in enumerate(intents) if x in ("b", None)]
    for r in R.top_cases(df, index, "q", "text", k=2, intent="want", probe=probe).filter("rank = 1").collect():
        full = [c for c, _ in brute_force(issues, queries[r.q], len(issues)) if c in of_b]
        assert r.case_order == full[0]


def met_rows(spark, issues, queries, k=3):
    """Posting entries that a search adds up, as a part of queries x cases x terms."""
    from unittest import mock

    index, seen = build(spark, issues), []
    df = spark.createDataFrame(list(enumerate(queries)), "q long, text string")
    whole = R.scores

    def counted(terms, blocks, index_, query_id):
        seen.append(terms.join(blocks, query_id).join(index_.postings, ["term", "block"]).selectExpr("sum(size(entries))").first()[0] or 0)
        return whole(terms, blocks, index_, query_id)

    with mock.patch.object(R, "scores", counted):
        got = {}
        for r in R.top_cases(df, index, "q", "text", k=k).orderBy("q", "rank").collect():
            got.setdefault(r.q, []).append((r.case_order, round(r.similarity, 6)))
    return got, sum(seen) / sum(len(issues) * len(set(grams(q))) for q in queries)


def test_queries_of_words_that_all_cases_share(spark):
    """No term is rare, so no list of postings is short; the bounds of the blocks leave most of them closed."""
    random.seed(6)
    common = "the common words of all"
    same = [f"{common} own{i}" for i in range(3000)]
    got, part = met_rows(spark, same, [common] * 25 + ["common words", "words of all the common"] * 12)
    assert part < 0.1 and got[0] == brute_force(same, common, 3)
    mixed = [" ".join([common, *(f"x{random.randrange(4000)}" for _ in range(random.randint(0, 12)))]) for _ in range(3000)]
    got, part = met_rows(spark, mixed, [common, "all the words", "of common words"] * 15)
    assert part < 0.1 and all(got[i] == brute_force(mixed, q, 3) for i, q in enumerate([common, "all the words", "of common words"]))
