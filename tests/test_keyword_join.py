import random

from pyspark.sql import functions as F

from caseweave.functions import keywords as K
from caseweave.operators import keyword_join as J

TEXTS = ["I can't log in!", "LOG IN now", "log  in", "catalog in", "login", "log in_", "a #fail today", "a#fail", "##fail", "#failure", "?!", "x?!", "what ?!?", None, "",
         "naïve Straße", "STRASSE", "e-mail e mail", "e-mail", "the end.", "the end", "new york city", "in new york", "end", "(new york)", "pay-pal's", "100% off", "100%", "5100% off",
         "wait...", "...", "no... wait", "a.b.c", "word " * 3000 + "log in"]
WORDS = ["log in", "can't", "#fail", "?!", "naïve", "straße", "e-mail", "e mail", "the end.", "the end", "new york", "new york city", "pay-pal", "100%", "100% off", "...",
         "end", "b", "a.b", "", "in!"]


def both(spark, texts, dictionary):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r["id"]: r["intents"] for r in J.all_matches(df, "id", "t", J.keyword_table(spark, dictionary)).collect()}
    want = {r["id"]: r["m"] for r in df.select("id", K.all_matches(F.col("t"), dictionary).alias("m")).collect()}
    return got, want


def test_same_as_the_expressions(spark):
    dictionary = [(f"i{n}", [w]) for n, w in enumerate(WORDS) if w] + [("two", ["LOGIN", "City"])]
    got, want = both(spark, TEXTS, dictionary)
    assert got == want and sum(map(len, want.values())) > 25


def test_random_pieces(spark):
    rng = random.Random(2)
    pieces = ["a", "b", "ab", " ", "  ", "-", ".", "!", "é", "7", "_"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(150)]
    dictionary = [(f"i{n}", ["".join(rng.choices(pieces, k=rng.randint(1, 4)))]) for n in range(40)]
    got, want = both(spark, texts, dictionary)
    assert got == want


def test_ten_thousand_keywords(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)] + ["the"]
    dictionary = [(f"i{n:03}", [" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(50)]) for n in range(200)]
    texts = [" ".join(rng.choices(words, k=40)) + " " + rng.choice(rng.choice(dictionary)[1]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    keywords = J.keyword_table(spark, dictionary)
    assert keywords.count() == 10_000
    got = {r["id"]: r["intent"] for r in J.first_match(df, "id", "t", keywords, "none").collect()}
    for i, text in enumerate(texts):
        padded = f" {text} "
        assert got[i] == next((name for name, ws in dictionary if any(f" {w} " in padded for w in ws)), "none")
    single = {r["id"]: r["intent"] for r in J.single_match(df, "id", "t", keywords).collect()}
    assert all(got[i] == intent for i, intent in single.items())
    counts = {r["intent"]: r["n"] for r in J.frequency(df, "id", "t", keywords, "none").collect()}
    assert sum(counts.values()) == 300
    assert J.all_matches(df.limit(0), "id", "t", keywords).count() == 0 and J.all_matches(df, "id", "t", keywords.limit(0)).filter("size(intents) > 0").count() == 0


def test_keywords_without_signs_carry_no_neighbours(spark):
    texts = ["One two, three four five six", "one two three four five", "two", "xtwo", None, "", ", ONE TWO"]
    plain = [("a", ["one two", "two"]), ("b", ["two three four five six", "one two three four five"]), ("c", ["three four five"])]
    got, want = both(spark, texts, plain)
    assert got == want and sorted(want[1]) == ["a", "b", "c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    plan = lambda dictionary: J.keyword_hits(df, "id", "t", J.keyword_table(spark, dictionary))._jdf.queryExecution().optimizedPlan().toString()
    assert "leftmost" not in plan(plain) and "leftmost" in plan([*plain, ("d", ["#two"])])
