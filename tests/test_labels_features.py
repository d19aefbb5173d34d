import math
import re
from collections import Counter

from pyspark.sql import functions as F

from caseweave import values as V
from caseweave.functions import accents, keywords as K
from caseweave.functions import text as X
from caseweave.operators import features as FE, labels as L
from caseweave.operators.classify import HYBRID_BLOCKS


def test_keyword_boundaries(one):
    values = ["wifi", "my wifi.", "wifis", "éwifi", "a wi-fi b", "WIFI!", "no service", "noservice", "_wifi", None, ""]
    got = one(lambda c: K.has_keyword(c, ["wifi", "wi-fi", "no service"]), values)
    want = [bool(v and any(re.search(rf"\b{re.escape(k)}\b", v.lower()) for k in ["wifi", "wi-fi", "no service"]))
            for v in values]
    assert got == want == [True, True, False, False, True, True, True, False, False, False, False]


def test_dictionary_order_and_matches(spark):
    df = spark.createDataFrame([("my battery and the update",), ("hello there",), ("cracked glass",)], "t string")
    assert [r.intent for r in L.label_first_match(df, "t").collect()] == [
        "battery_power_drain", "general_inquiry_advice", "hardware_screen_physical_damage"]
    assert [r.intents for r in L.label_all_matches(df, "t").collect()][0] == ["battery_power_drain", "software_update_os"]
    assert [r.intent for r in L.label_single_match(df, "t").collect()] == ["hardware_screen_physical_damage"]
    freq = {r.intent: (r.n, r.percent) for r in L.intent_frequency(df, "t").collect()}
    assert freq["battery_power_drain"] == (1, 33.3) and freq["audio_sound_microphone"] == (0, 0.0)
    assert freq[V.UNCLASSIFIED] == (1, 33.3) and len(freq) == 11


def test_taxonomy_join_and_acknowledgements(spark):
    df = spark.createDataFrame([("apple_id_account_access",), ("unknown",)], "intent string")
    got = {r.intent: (r.risk_level, r.default_action) for r in L.taxonomy_join(df, L.taxonomy_dimension(spark)).collect()}
    assert got == {"apple_id_account_access": ("high", V.ESCALATE), "unknown": ("medium", V.ESCALATE)}
    acks = spark.createDataFrame([("Thanks",), ("DM SENT",), ("thanks a lot",)], "t string")
    assert [r.t for r in L.drop_acknowledgements(acks, "t").collect()] == ["thanks a lot"]


def test_training_sample(spark):
    rows = [(i, f"conv_{i}", t) for i, t in enumerate(
        ["my battery dies", "battery update now", "screen is cracked", "sound is bad", "wifi down"], start=1)]
    threads = spark.createDataFrame(rows, "root_tweet_id long, conversation_id string, customer_cleaned_issue string")
    held = spark.createDataFrame([("conv_3",)], "conversation_id string")
    got = L.training_sample(threads, held, 2).collect()
    assert [(r.conversation_id, r.intent) for r in got] == [
        ("conv_1", "battery_power_drain"), ("conv_4", "audio_sound_microphone")]


TEXTS = ["It's the dogs' 'quoted' x''y a'-b", "Étude naïve ﬁne ½ … ™ 한글 Ａ Źa̧ ٣", "a", "", "!!! 😀", "don't_stop 2x",
         "ß İstanbul straße", "one two three four"]


def test_tokens_match_python(one):
    plain = [t for t in TEXTS if "İ" not in t]
    assert one(X.tokenize, plain) == [re.findall(r"\b[\w']+\b", t.lower()) for t in plain]
    assert one(lambda c: X.tokenize(c, X.TOKEN_PLAIN), plain) == [re.findall(r"\b\w+\b", t.lower()) for t in plain]


def test_accents_match_python(one):
    odd = TEXTS + ["".join(chr(c) for c in range(a, a + 400) if not 0xD800 <= c < 0xE000) for a in range(0x80, 0x3400, 400)]
    assert one(accents.strip_accents, odd) == [accents.fold(t) for t in odd]


def word_grams(tokens, low, high):
    return [" ".join(tokens[i:i + n]) for n in range(low, high + 1) for i in range(len(tokens) - n + 1)]


def char_grams(text, low, high):
    out = []
    for w in text.lower().split():
        w = f" {w} "
        for n in range(low, high + 1):
            out += [w[i:i + n] for i in range(max(len(w) - n + 1, 1))]
            if len(w) <= n:
                break
    return out


def test_word_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(X.word_ngrams(F.col("t"), 1, 3)).collect()]
    assert got == [word_grams(["a", "b", "c", "d"], 1, 3), ["a"], []]
    assert [r[0] for r in df.select(X.word_ngrams(F.col("t"), 2, 3)).collect()][0] == word_grams(list("abcd"), 2, 3)


def test_char_ngrams(one):
    values = ["a bb ccc dddd eeeeee", "", "Ünï x"]
    assert one(lambda c: X.char_wb_ngrams(c, 3, 5), values) == [char_grams(v, 3, 5) for v in values]


def test_weights_match_formula(spark):
    docs = [(1, "the cat the dog"), (2, "the bird"), (3, "")]
    df = spark.createDataFrame(docs, "id long, text string")
    counts = FE.term_counts(df, "id", "text", FE.Analyzer("word", 1, 1))
    table = FE.idf(FE.vocabulary(counts, None), 3)
    got = {(r.id, r.term): r.weight for r in FE.tfidf_weights(counts, table.select("term", "idf"), "id").collect()}
    df_of = {"the": 2, "cat": 1, "dog": 1, "bird": 1}
    for i, text in docs:
        tf = Counter(text.split())
        raw = {t: (1 + math.log(n)) * (math.log(4 / (1 + df_of[t])) + 1) for t, n in tf.items()}
        length = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        for t, v in raw.items():
            assert abs(got[(i, t)] - v / length) < 1e-12
    assert len(got) == 5


def test_vocabulary_ties(spark):
    df = spark.createDataFrame([(1, "b a c c")], "id long, text string")
    counts = FE.term_counts(df, "id", "text", FE.Analyzer("word", 1, 1))
    assert sorted(r.term for r in FE.vocabulary(counts, 2).collect()) == ["a", "c"]


def test_feature_union_keeps_block_lengths(spark):
    df = spark.createDataFrame([(1, "hello world again")], "id long, text string")
    blocks = []
    for name, analyzer in HYBRID_BLOCKS:
        counts = FE.term_counts(df, "id", "text", analyzer)
        blocks.append((name, FE.tfidf_weights(counts, FE.idf(FE.vocabulary(counts, 50), 1).select("term", "idf"), "id")))
    sums = FE.feature_union(blocks).groupBy("block").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert {r.block: round(r.s, 9) for r in sums} == {"word": 1.0, "char": 1.0}
