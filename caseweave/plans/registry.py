"""Named queries over the test tables: (spark, folder of the tables) -> DataFrame.

Arrays and maps are joined to text in the results, and numbers that may be null are written as
text, so that other engines can compare them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import values as V
from ..functions import accents, keywords as K
from ..functions import text as X
from ..operators import (brand as B, classify as C, decide as J, dense as DN, draft as I, failures as FM, features as FE, keyword_join as KJ,
                         golden as G, index_store as IS, judge as JU, labels as L, leakage as LK, metrics as M, profile as P, profile_sketches as PS,
                         retrieve as R, threads as D)
from ..session import fresh_path, materialize
from ..sources import tables as SRC
from ..streaming import streams as S
from . import bindings as T
from . import evaluation as E
from . import triage as TR

# Lower floors than the defaults, so that both decisions occur on the invented text
LIMITS = TR.Thresholds(min_similarity=0.20, min_grounding=0.25)
DOC_WORDS = FE.Analyzer("word", 1, 2, True, X.TOKEN)


def joined(c: str | Column, separator: str = "|") -> Column:
    return F.array_join(c, separator)


# ---------------------------------------------------------------- cleaning
def validate_records(s, d):
    worn = T.messages(s, d).withColumn("text", F.when(F.length("text") > 90, F.col("text")).otherwise(
        F.when(F.col("inbound"), F.lit(" \t\n "))))
    return B.validate_records(worn).select("tweet_id", "author_id")


def strip_control_chars(s, d):
    dirty = F.concat(F.lit("\x01\x7f"), "text", F.lit("\x0b\t\x1f�end"))
    return T.table(s, d, "documents").select(
        "doc_id", F.md5(X.strip_control_chars(dirty)).alias("hash"), F.length(X.strip_control_chars(dirty)).cast("long").alias("n"))


def normalize_whitespace(s, d):
    spaced = F.concat(F.lit("   "), "text", F.lit(" \n　x\t"))
    clean = X.normalize_whitespace(spaced)
    return T.table(s, d, "documents").select("doc_id", F.md5(clean).alias("hash"), F.length(clean).cast("long").alias("n"))


def strip_brand_mention(s, d):
    return T.messages(s, d).select("tweet_id", X.clean_customer_text(F.col("text"), "@brandcare").alias("cleaned"))


def clean_brand_reply(s, d):
    return T.messages(s, d).filter(~F.col("inbound")).select(
        "tweet_id", X.clean_brand_reply(F.col("text")).alias("cleaned"))


def assign_role(s, d):
    return T.messages(s, d).select("tweet_id", X.assign_role(F.col("inbound"), F.col("author_id"), T.BRAND).alias("role"))


def parse_created_at(s, d):
    at = X.parse_created_at(F.when(F.col("inbound"), F.col("created_at")).otherwise(F.col("text")))
    return T.messages(s, d).select("tweet_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


def parent_id(s, d):
    return T.messages(s, d).select("tweet_id", X.parent_id(F.col("in_response_to_tweet_id")).cast("string").alias("parent_id"))


def word_count(s, d):
    return T.table(s, d, "documents").select("doc_id", X.word_count(F.col("text")).cast("long").alias("words"))


def min_words(s, d):
    return L.min_words(T.customer_messages(s, d), "cleaned", 12).select("tweet_id")


def drop_acknowledgements(s, d):
    short = T.messages(s, d).withColumn("text", F.when(~F.col("inbound"), "Thank You").otherwise(F.col("text")))
    return L.drop_acknowledgements(short, "text").select("tweet_id")


# ---------------------------------------------------------------- brands
def extract_brand(s, d):
    return B.extract_brand(T.messages(s, d), T.BRAND).select("tweet_id", "author_id", "inbound", "text")


def dedup_tweets(s, d):
    return B.dedup_tweets(T.doubled_messages(s, d)).select("tweet_id", "author_id", "text")


def sort_tweets(s, d):
    return B.sort_tweets(T.messages(s, d).select("tweet_id", "author_id"))


def extract_all_brands(s, d):
    return B.extract_all_brands(T.messages(s, d, True)).select("brand", "tweet_id", "inbound")


# ---------------------------------------------------------------- threads
def _links(s, d):
    return D.reply_links(T.messages(s, d), T.BRAND)


def _subset_links(s, d):
    return D.reply_links(T.corpus(s, d).tweets, T.BRAND)


def first_child(s, d):
    return D.first_child(_links(s, d))


def conversation_roots(s, d):
    return D.conversation_roots(_subset_links(s, d)).withColumn("parent_id", F.col("parent_id").cast("string"))


def customer_roots(s, d):
    return D.customer_roots(_links(s, d)).select("tweet_id")


def reply_chains(s, d):
    return D.reply_chains(_links(s, d)).select(
        "root_tweet_id", F.col("turn_index").cast("long").alias("turn_index"), "tweet_id", "role")


def thread_filter(s, d):
    return D.thread_filter(D.reply_chains(_subset_links(s, d)), 4)


def conversation_turns(s, d):
    return T.corpus(s, d).turns.withColumns({
        "turn_index": F.col("turn_index").cast("long"),
        "in_response_to_tweet_id": F.col("in_response_to_tweet_id").cast("string")})


def conversation_threads(s, d):
    subset = B.dedup_tweets(B.extract_brand(T.messages(s, d), T.BRAND))
    return D.conversation_threads(D.conversation_turns(subset, T.BRAND))


def conversation_history(s, d):
    return D.conversation_history(T.corpus(s, d).turns, T.BRAND, 3).select("root_tweet_id", "part", "history")


# ---------------------------------------------------------------- weak labels
def label_first_match(s, d):
    return L.label_first_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS, T.DEFAULT).select("tweet_id", "intent")


def label_single_match(s, d):
    return L.label_single_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS).select("tweet_id", "intent")


def label_all_matches(s, d):
    return L.label_all_matches(T.customer_messages(s, d), "cleaned", T.KEYWORDS).select(
        "tweet_id", joined("intents").alias("intents"))


def label_documents(s, d):
    return L.label_first_match(T.table(s, d, "documents"), "text", T.KEYWORDS, T.DEFAULT).select("doc_id", "intent")


def keyword_table_matches(s, d):
    """Documents by a large dictionary: all pairs of neighbouring words of the benchmark items, dealt to 20 intents."""
    words = F.filter(F.split(F.lower("text"), r"[^a-z]+"), lambda w: F.length(w) > 0)
    pairs = T.table(s, d, "benchmark").select("item_id", words.alias("w")).filter("size(w) > 1")
    pairs = pairs.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(
        " ", F.element_at("w", i), F.element_at("w", i + 1)))).alias("keyword"))
    number = F.col("item_id") % 20
    keywords = pairs.select((number + 1).cast("int").alias("priority"), F.concat(F.lit("set"), number.cast("string")).alias("intent"), "keyword").distinct()
    return KJ.all_matches(T.table(s, d, "documents"), "doc_id", "text", keywords).select("doc_id", joined("intents").alias("intents"))


def intent_frequency(s, d):
    df = L.min_words(T.customer_messages(s, d), "cleaned", 3)
    return L.intent_frequency(df, "cleaned", T.KEYWORDS, T.TAXONOMY).select("intent", "n", "percent")


def intent_samples(s, d):
    df = L.min_words(T.customer_messages(s, d), "cleaned", 3)
    return L.intent_samples(df, "cleaned", "tweet_id", 5, T.KEYWORDS).select("intent", "sample_no", "tweet_id")


def training_sample(s, d):
    return T.training_rows(s, d, None).select("tweet_id", "conversation_id", "intent")


def taxonomy_join(s, d):
    df = L.label_first_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS, "unlisted")
    return L.taxonomy_join(df, T.taxonomy(s)).select("tweet_id", "intent", "risk_level", "default_action")


# ---------------------------------------------------------------- text features
def tokenize_words(s, d):
    return T.table(s, d, "documents").select("doc_id", F.explode(X.tokenize(F.col("text"))).alias("token")).groupBy(
        "doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def word_ngrams(s, d):
    tokens = T.customer_messages(s, d).select("tweet_id", X.tokenize(F.col("cleaned")).alias("t"))
    return tokens.select("tweet_id", joined(X.word_ngrams(F.col("t"), 1, 3)).alias("ngrams"))


def char_wb_ngrams(s, d):
    return T.customer_messages(s, d).select(
        "tweet_id", joined(X.char_wb_ngrams(F.col("cleaned"), 3, 5)).alias("ngrams"))


def strip_accents(s, d):
    return T.table(s, d, "documents").select(
        "doc_id", F.md5(accents.strip_accents(F.lower("text"))).alias("hash"))


def _doc_vocabulary(s, d, max_features=None):
    return FE.corpus_vocabulary(T.table(s, d, "documents"), "doc_id", "text", replace(DOC_WORDS, max_features=max_features))


def vocabulary(s, d):
    return _doc_vocabulary(s, d).select("term", "n")


def vocabulary_top(s, d):
    """The max_features option: the 2,000 most frequent terms."""
    return _doc_vocabulary(s, d, 2000).select("term", "n")


def idf(s, d):
    n = T.table(s, d, "documents").count()
    return FE.idf(_doc_vocabulary(s, d), n).select("term", "df", F.round("idf", 6).alias("idf"))


def tfidf_weights(s, d):
    docs = T.table(s, d, "documents")
    return FE.corpus_weights(docs, "doc_id", "text", DOC_WORDS, docs.count()).select("doc_id", "term", F.round("weight", 5).alias("weight"))


def feature_union(s, d):
    messages = T.customer_messages(s, d)
    n = messages.count()
    blocks = []
    for name, analyzer in C.HYBRID_BLOCKS:
        blocks.append((name, FE.corpus_weights(messages, "tweet_id", "cleaned", analyzer, n)))
    return FE.feature_union(blocks).select("tweet_id", "block", "term", F.round("weight", 5).alias("weight"))


# ---------------------------------------------------------------- classification
def majority_baseline(s, d):
    df = L.label_first_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS, T.DEFAULT)
    return C.majority_baseline(df.drop("intent"), df, "intent").select("tweet_id", "intent", "confidence")


def majority_quality(s, d):
    return C.majority_label(T.table(s, d, "labels").withColumn("label", F.col("quality").cast("string")), "label")


def balanced_weights(s, d):
    df = L.label_single_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS)
    return C.balanced_weights(df, "intent").withColumn("weight", F.round("weight", 6))


def _scored(s, d):
    return T.rule_scores(T.customer_messages(s, d), "cleaned")


def predict_top2(s, d):
    return C.predict_top2(_scored(s, d)).select("tweet_id", "intent", "confidence", "margin", "is_ambiguous")


def class_probabilities(s, d):
    return C.class_probabilities(_scored(s, d)).select(
        "tweet_id", F.explode("all_probabilities").alias("intent", "probability"))


def triggered_keywords(s, d):
    df = C.predict_top2(_scored(s, d))
    return C.triggered_keywords(df, "cleaned", T.taxonomy(s)).select(
        "tweet_id", "intent", joined("triggered_keywords").alias("triggered"))


def _fitted(s, d, name, limit=None):
    """The model fitted on all training rows, or on the first `limit`; in thread order, so that its sums come out alike."""
    fit = C.fit_hybrid if name == "hybrid" else C.fit_baseline
    rows = lambda: T.training_rows(s, d, limit) if limit else T.training_rows(s, d, None).orderBy("tweet_id")
    return T._once(s, d, f"{name}{limit or ''}", lambda: fit(rows(), "tweet_id", "cleaned_text", "intent"))


def tfidf_baseline(s, d):
    df = C.class_scores(T.customer_messages(s, d), "tweet_id", "cleaned", _fitted(s, d, "baseline", V.MAX_BASELINE_ROWS))
    return C.predict_top2(df).select("tweet_id", "intent", "confidence")


def hybrid_classifier(s, d):
    df = C.predict(T.customer_messages(s, d), "tweet_id", "cleaned", _fitted(s, d, "hybrid"), T.taxonomy(s))
    return df.select("tweet_id", "intent", "confidence", "margin", "is_ambiguous", "risk_level", "default_action",
                     joined("triggered_keywords").alias("triggered"), "method")


def _certificate(s, d, name, limit):
    found = C.optimality(T.training_rows(s, d, limit), "tweet_id", "cleaned_text", "intent", _fitted(s, d, name, limit))
    everything = F.sum(F.col("documents") * F.col("class_weight")).over(Window.partitionBy())  # one row per class
    return found.select("intent", "documents", F.round("class_weight", 6).alias("class_weight"),
                        F.round(F.col("mass") / everything, 3).alias("mass_share"), (F.col("gradient") < 1e-4).alias("optimal"))


def tfidf_baseline_certificate(s, d):
    """The fitted baseline meets the conditions of an optimum, class by class."""
    return _certificate(s, d, "baseline", V.MAX_BASELINE_ROWS)


def hybrid_classifier_certificate(s, d):
    """A hybrid model meets the conditions of an optimum, class by class: that of the first rows, which the SQL twin counts too."""
    return _certificate(s, d, "hybrid", V.MAX_TRAINING_ROWS)


# A small model with given numbers, so that scoring can be checked in plain SQL: (term, idf, coefficients) by rule
FIXED_CLASSES, FIXED_INTERCEPTS = ["alpha_power", "beta_update", "gamma_account"], [0.1, 0.0, -0.1]
FIXED_TERMS = [(w, 1 + j / 10, [((j * (c + 2)) % 7 - 3) / 4 for c in range(3)])
               for j, w in enumerate(w for _, ws in T.KEYWORDS for w in ws)]


def fixed_model(s):
    terms = s.createDataFrame([("word", *t) for t in FIXED_TERMS], "block string, term string, idf double, coef array<double>")
    return C.LinearModel(FIXED_CLASSES, FIXED_INTERCEPTS, terms, [("word", FE.Analyzer())], "fixed", True)


def class_scores_fixed(s, d):
    """The model path, scores to prediction, with the fixed coefficients."""
    df = C.predict(T.customer_messages(s, d), "tweet_id", "cleaned", fixed_model(s), T.taxonomy(s))
    return df.select("tweet_id", "intent", "confidence", "margin", "is_ambiguous", "risk_level", "default_action", "method")


# ---------------------------------------------------------------- retrieval
def build_cases(s, d):
    return T.cases(s, d)


def build_index(s, d):
    return R.postings_long(T.index(s, d)).withColumn("weight", F.round("weight", 5))


def search_topk(s, d):
    found = R.search_topk(T.customer_messages(s, d), T.index(s, d), "tweet_id", "cleaned", 3)
    return found.select("tweet_id", "rank", "case_id", "similarity_score")


def search_by_intent(s, d):
    asked = L.label_first_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS, "unlisted")
    found = R.search_topk(asked, T.index(s, d), "tweet_id", "cleaned", 3, intent="intent")
    return found.select("tweet_id", "rank", "case_id", "similarity_score")


def min_similarity(s, d):
    found = R.search_topk(T.customer_messages(s, d), T.index(s, d), "tweet_id", "cleaned", 5, None, 0.15)
    return found.select("tweet_id", "rank", "case_id", "similarity_score")


def evidence_array(s, d):
    found = R.search_topk(T.customer_messages(s, d), T.index(s, d), "tweet_id", "cleaned", 3)
    return R.evidence_array(found, "tweet_id").select("tweet_id", joined(F.col("evidence.case_id")).alias("case_ids"))


# ---------------------------------------------------------------- drafting and decisions
def _evidence(s, d):
    asked = T.customer_messages(s, d)
    return TR.add_evidence(asked, TR.evidence(asked, T.index(s, d), "tweet_id", "cleaned"), "tweet_id")


def draft_reply(s, d):
    return I.draft_reply(_evidence(s, d), min_grounding=0.25).select(
        "tweet_id", "reply", joined("evidence_ids").alias("evidence_ids"), "evidence_summary", "grounding_score",
        "unsupported_claims_detected", "is_grounded", "generation_method")


def grounding_prompts(s, d):
    df = L.label_first_match(_evidence(s, d), "cleaned", T.KEYWORDS, T.DEFAULT)
    return I.grounding_prompts(df, "cleaned", "intent").select("tweet_id", "prompt")


def escalation_gates(s, d):
    """Every gate on every message: the draft of messages without keywords is taken as absent."""
    df = T.rule_classifier(s)(_evidence(s, d), "tweet_id", "cleaned")
    df = I.draft_reply(df, min_grounding=0.25).withColumn("has_reply", F.col("confidence") > 0.1)
    return J.decide(df, 0.60, 0.20).select(
        "tweet_id", "decision", "reason", joined("passed_gates").alias("passed_gates"),
        joined("failed_gates").alias("failed_gates"), "is_safe_to_automate", "confidence_score", "retrieval_score")


def escalation_gates_nulls(s, d):
    """The same gates where one input in turn is missing, or stands exactly at its limit."""
    df = T.rule_classifier(s)(_evidence(s, d), "tweet_id", "cleaned")
    df = I.draft_reply(df, min_grounding=0.25).withColumn("has_reply", F.lit(True))
    turn = F.col("tweet_id") % 7
    missing = {1: "risk_level", 2: "confidence", 3: "is_ambiguous", 4: "top_similarity"}
    df = df.withColumns({name: F.when(turn != k, F.col(name)) for k, name in missing.items()})
    df = df.withColumns({"confidence": F.when(turn == 5, 0.60).otherwise(F.col("confidence")),
                         "top_similarity": F.when(turn == 5, 0.20).otherwise(F.col("top_similarity"))})
    return J.decide(df, 0.60, 0.20).select(
        "tweet_id", "decision", "reason", joined("passed_gates").alias("passed_gates"),
        joined("failed_gates").alias("failed_gates"), "is_safe_to_automate")


def flat(outputs: DataFrame, key: str) -> DataFrame:
    evidence = F.transform("historical_evidence", lambda e: F.concat(
        e["case_id"], F.lit(":"), F.round(e["similarity_score"] * 10000, 0).cast("int").cast("string")))
    return outputs.select(
        key, "customer_message", "cleaned_message", "predicted_intent", "intent_confidence", "intent_margin",
        "is_ambiguous", "risk_level", F.coalesce(joined(evidence), F.lit("")).alias("historical_evidence"),
        "draft_reply", joined("evidence_ids").alias("evidence_ids"), "grounding_score", "decision",
        "escalation_reason", "is_safe_to_automate", joined("passed_gates").alias("passed_gates"),
        joined("failed_gates").alias("failed_gates"))


def triage_rules(s, d, limits=LIMITS):
    """The flagship: every customer message through the whole flow, with the stand-in classifier."""
    asked = T.messages(s, d).filter("inbound").select("tweet_id", "text")
    return flat(TR.triage(asked, "tweet_id", "text", T.index(s, d), T.rule_classifier(s), T.HANDLE, limits), "tweet_id")


def triage_default_limits(s, d):
    return triage_rules(s, d, TR.Thresholds()).select("tweet_id", "decision", "escalation_reason", "failed_gates")


def triage_model(s, d):
    """The same flow with the fitted hybrid classifier."""
    asked = T.messages(s, d).filter("inbound").select("tweet_id", "text")
    classifier = TR.model_classifier(_fitted(s, d, "hybrid"), T.taxonomy(s))
    return flat(TR.triage(asked, "tweet_id", "text", T.index(s, d), classifier, T.HANDLE, LIMITS), "tweet_id")


# ---------------------------------------------------------------- evaluation set and leakage
def _pool(s, d):
    return G.golden_pool(T.corpus(s, d).threads, T.KEYWORDS)


def stratified_sample(s, d):
    return G.stratified_sample(_pool(s, d), T.PER_INTENT).select("conversation_id", "gold_intent", "draw_no")


def difficulty(s, d):
    words = X.word_count(F.col("customer_cleaned_issue"))
    return _pool(s, d).select("conversation_id", G.difficulty(words, F.col("turn_count")).alias("difficulty"))


def gold_labels(s, d):
    single = G.single_matches(_pool(s, d))
    return G.gold_labels(single, T.taxonomy(s)).select(
        "conversation_id", "gold_intent", "gold_decision", "gold_reason", "risk_level", "difficulty")


def ambiguous_sample(s, d):
    return G.ambiguous_sample(_pool(s, d), T.AMBIGUOUS).select("conversation_id", "gold_intent", "gold_reason")


def top_up(s, d):
    chosen = G.stratified_sample(_pool(s, d), T.PER_INTENT)
    return G.top_up(_pool(s, d), chosen, T.TARGET).select("conversation_id", "gold_decision", "gold_reason")


def golden_set(s, d):
    return T.golden(s, d)


def golden_distribution(s, d):
    return G.golden_distribution(T.golden(s, d))


def leak_duplicate_ids(s, d):
    twice = T.golden(s, d).unionByName(T.golden(s, d, T.SMALL_SET))
    return LK.duplicate_ids(twice)


def leak_unregistered(s, d):
    return LK.unregistered_ids(T.golden(s, d), T.golden(s, d, T.SMALL_SET).select("conversation_id"))


def leak_id_overlap(s, d):
    return LK.id_overlap(T.golden(s, d), T.cases(s, d))


def leak_text_overlap(s, d):
    return LK.text_overlap(T.corpus(s, d).threads, "conversation_id", "customer_cleaned_issue", T.golden(s, d),
                           "customer_message")


def leak_text_documents(s, d):
    """Documents of other sources whose whole text also occurs in the first source."""
    docs = T.table(s, d, "documents")
    held, rest = docs.filter("source = 'src0'"), docs.filter("source <> 'src0'")
    return LK.text_overlap(rest, "doc_id", "text", held, "text").select("doc_id")


def leak_label_in_input(s, d):
    g = T.golden(s, d).withColumn("customer_message", F.when(
        F.col("difficulty") == "hard", F.concat("customer_message", F.lit(" gold_intent"))).otherwise(
        F.col("customer_message")))
    return LK.label_in_input(g)


def leakage_report(s, d):
    g = T.golden(s, d, T.SMALL_SET)
    outside = T.corpus(s, d).threads.join(g.select("conversation_id"), "conversation_id", "left_anti")
    return LK.leakage_report(g, g.select("conversation_id"), T.cases(s, d), outside)


# ---------------------------------------------------------------- evaluation aggregates
def labelled_pairs(s, d):
    """Gold = first matching intent; predicted = the intent of the most similar case. Written once."""
    def make():
        gold = L.label_first_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS, T.DEFAULT).select(
            "tweet_id", F.col("intent").alias("gold_intent"))
        near = R.search_topk(T.customer_messages(s, d), T.index(s, d), "tweet_id", "cleaned", 1).select(
            "tweet_id", F.col("case_intent").alias("predicted_intent"))
        return materialize(gold.join(near, "tweet_id"), "pairs")
    return T._once(s, d, "pairs", make)


def accuracy(s, d):
    return M.accuracy(labelled_pairs(s, d), "gold_intent", "predicted_intent")


def per_class_prf(s, d):
    return M.per_class_prf(labelled_pairs(s, d), "gold_intent", "predicted_intent")


def macro_prf(s, d):
    return M.macro_prf(labelled_pairs(s, d), "gold_intent", "predicted_intent")


def confusion_matrix(s, d):
    return M.confusion_matrix(labelled_pairs(s, d), "gold_intent", "predicted_intent")


def quality_prf(s, d):
    docs = T.table(s, d, "documents").select("doc_id", F.when(F.col("n_chars") > 400, 1).otherwise(0).alias("p"))
    pairs = T.table(s, d, "labels").join(docs, "doc_id").select(
        F.col("quality").cast("string").alias("t"), F.col("p").cast("string").alias("p"))
    return M.per_class_prf(pairs, "t", "p")


def _gold_results(s, d):
    gold = L.label_first_match(T.customer_messages(s, d), "cleaned", T.KEYWORDS, T.DEFAULT).withColumnRenamed(
        "intent", "gold_intent")
    found = R.search_topk(gold, T.index(s, d), "tweet_id", "cleaned", 5)
    return gold, found.join(gold.select("tweet_id", "gold_intent"), "tweet_id")


def retrieval_metrics(s, d):
    """Recall at 1, 3 and 5, mean reciprocal rank, mean top similarity."""
    gold, found = _gold_results(s, d)
    return M.retrieval_metrics(M.first_relevant(gold, found, "tweet_id", "gold_intent"))


def first_relevant(s, d):
    gold, found = _gold_results(s, d)
    return M.first_relevant(gold, found, "tweet_id", "gold_intent").withColumn(
        "first_rank", F.col("first_rank").cast("string"))


def golden_outputs(s, d):
    def make():
        return materialize(E.golden_outputs(T.golden(s, d), T.index(s, d, (T.PER_INTENT, T.AMBIGUOUS, T.TARGET)),
                                            T.rule_classifier(s), T.HANDLE, LIMITS), "outputs")
    return T._once(s, d, "outputs", make)


def escalation_safety(s, d):
    return M.escalation_safety(golden_outputs(s, d), "gold_decision", "decision")


def _judged(s, d):
    def make():
        drafted = I.draft_reply(_evidence(s, d), min_grounding=0.25)
        return materialize(JU.judge_scores(drafted, "cleaned", "reply").select(
            "tweet_id", *JU.AXES, "overall_score", "verdict", "feedback"), "judged")
    return T._once(s, d, "judged", make)


def judge_scores(s, d):
    return _judged(s, d)


def judge_summary(s, d):
    return JU.judge_summary(_judged(s, d))


def agreement_sample(s, d):
    return JU.agreement_sample(_judged(s, d), "tweet_id", 50).select("tweet_id", "overall_score")


def document_ratings(s, d):
    """Two views of every labelled document as two raters: its words and quality label, its length and a length rule."""
    # words are counted before the join, so that no text moves
    docs = T.table(s, d, "documents").select("doc_id", "n_chars", X.word_count(F.col("text")).cast("double").alias("human_score"))
    verdict = lambda test: F.when(test, "PASS").otherwise("FAIL")
    return docs.join(T.table(s, d, "labels").select("doc_id", "quality"), "doc_id").select(
        "doc_id", "human_score", verdict(F.col("quality") == 1).alias("human_verdict"),
        (F.col("n_chars") / 6).alias("overall_score"), verdict(F.col("n_chars") > 400).alias("verdict"))


def rater_correlations(s, d):
    """Pearson and Spearman over every labelled document."""
    return JU.correlations(document_ratings(s, d), "human_score", "overall_score")


def cohen_kappa(s, d):
    return JU.cohen_kappa(document_ratings(s, d), "human_verdict", "verdict")


def rater_agreement(s, d):
    return JU.rater_agreement(document_ratings(s, d))


def failure_modes(s, d):
    outputs = golden_outputs(s, d).drop("risk_level")
    return FM.failure_modes(outputs, "id", ["gamma_account", "delta_billing"], "the", ("ing", "line"), "and")


def model_comparison(s, d):
    """Majority, nearest case and keyword stand-in side by side on all customer messages."""
    pairs = labelled_pairs(s, d)
    rule = C.predict_top2(_scored(s, d)).select("tweet_id", F.col("intent").alias("predicted_intent"))
    gold = pairs.select("tweet_id", "gold_intent")
    stacked = (pairs.withColumn("system", F.lit("nearest_case"))
               .unionByName(gold.join(rule, "tweet_id").withColumn("system", F.lit("keyword_hits")))
               .unionByName(C.majority_baseline(gold, gold, "gold_intent").select(
                   "tweet_id", "gold_intent", F.col("intent").alias("predicted_intent"),
                   F.lit("majority_baseline").alias("system"))))
    return M.model_comparison(stacked, "gold_intent", "predicted_intent")


def majority_on_gold(s, d):
    return C.majority_label(T.golden(s, d), "gold_intent")


def evaluation_record(s, d):
    """The whole benchmark as one nested row, with the fitted models."""
    sizes = (T.PER_INTENT, T.AMBIGUOUS, T.TARGET)
    classifier = TR.model_classifier(_fitted(s, d, "hybrid"), T.taxonomy(s))
    row = E.evaluate(T.golden(s, d), T.index(s, d, sizes), classifier, T.HANDLE, _fitted(s, d, "baseline", V.MAX_BASELINE_ROWS), LIMITS, document_ratings(s, d))
    return row.select(*[F.to_json(c).alias(c) if c != "golden_set_size" else F.col(c) for c in row.columns])


# ---------------------------------------------------------------- profile
def null_counts(s, d):
    return P.null_counts(T.messages(s, d))


def direction_counts(s, d):
    return P.direction_counts(T.messages(s, d))


def brand_reply_counts(s, d):
    return P.brand_reply_counts(T.messages(s, d, True), 30)


def text_statistics(s, d):
    return P.text_statistics(T.messages(s, d))


def text_statistics_documents(s, d):
    return P.text_statistics(T.table(s, d, "documents"))


def date_range(s, d):
    pattern = "yyyy-MM-dd HH:mm:ss"
    return P.date_range(T.messages(s, d)).select(
        F.date_format("first_at", pattern).alias("first_at"), F.date_format("last_at", pattern).alias("last_at"))


def brand_mentions(s, d):
    return B.brand_mentions(T.messages(s, d, True)).select("tweet_id", "brand")


def resolution_rich(s, d):
    return P.resolution_rich(T.messages(s, d, True), T.RICH_WORDS)


def conversation_estimate(s, d):
    m = T.messages(s, d, True)
    both = P.brand_reply_counts(m, None).join(P.mention_counts(B.brand_mentions(m)), "brand", "left").na.fill(0)
    return both.select("brand", P.conversation_estimate(F.col("first_contacts"), F.col("outbound_brand_replies")).alias(
        "estimated_conversations"))


def _days(s, d, many=False):
    return T.messages(s, d, many).withColumn("day", X.parse_created_at(F.col("created_at")).cast("date"))


def text_statistics_sketched(s, d):
    """Text statistics merged from stored days, and whether the medians are within their bound of the exact ranks."""
    path = fresh_path(s, "days")
    PS.write_days(PS.text_sketches(_days(s, d), "day"), path)
    merged = PS.text_statistics(PS.read_days(s, path))
    sizes = T.messages(s, d).filter("text is not null").select(F.length("text").alias("c"), X.word_count(F.col("text")).alias("w"))

    def within(c, median):
        share = lambda side: F.avg(side.cast("double"))
        return (share(F.col(c) < F.col(median)) <= 0.5 + PS.RANK_ERROR) & (share(F.col(c) <= F.col(median)) >= 0.5 - PS.RANK_ERROR)

    near = sizes.join(F.broadcast(merged.select("char_length_median", "word_count_median")), F.lit(True)).agg(  # one row
        within("c", "char_length_median").alias("char_length_median_near"), within("w", "word_count_median").alias("word_count_median_near"))
    return merged.select("n", "char_length_mean", "char_length_min", "char_length_max", "word_count_mean").join(F.broadcast(near), F.lit(True))


def vocabulary_diversity_sketched(s, d):
    """Exact vocabulary sizes, and whether those merged from stored days are within their bound."""
    path, mentions = fresh_path(s, "days"), B.brand_mentions(_days(s, d, True))
    PS.write_days(PS.vocabulary_sketches(mentions, "day"), path)
    merged = PS.vocabulary_diversity(PS.read_days(s, path)).withColumnRenamed("customer_vocabulary_diversity", "estimate")
    exact = vocabulary_diversity(s, d).join(merged, "brand", "left")
    error = F.abs(F.col("estimate") - F.col("customer_vocabulary_diversity"))
    return exact.select("brand", "customer_vocabulary_diversity", (error <= PS.SIZE_ERROR * F.col("customer_vocabulary_diversity")).alias("near"))


def vocabulary_diversity(s, d):
    return P.vocabulary_diversity(B.brand_mentions(T.messages(s, d, True)))


def sample_messages(s, d):
    m = T.messages(s, d, True)
    return P.sample_messages(B.brand_mentions(m), m, 3)


def brand_ranking(s, d):
    return P.brand_ranking(T.messages(s, d, True)).withColumn(
        "sample_customer_issues", joined("sample_customer_issues"))


# ---------------------------------------------------------------- streams
def _stream(s, d, name):
    schema = T.table(s, d, name).schema
    return s.readStream.schema(schema).parquet(f"{d}/{name}.parque[t]")  # a glob takes a file and a folder of part files alike


def _drain(s, stream, name):
    path = fresh_path(s, name)
    S.run_to_table(stream, path, fresh_path(s, name + "-log")).awaitTermination()
    return s.read.schema(stream.schema).parquet(path)


def stream_clean_label(s, d):
    stream = S.clean_label(T.as_messages(_stream(s, d, "conversations")), T.BRAND, T.KEYWORDS, T.DEFAULT)
    return _drain(s, stream, "labelled")


def stream_dedup(s, d):
    events = _stream(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    return _drain(s, S.dedup(events.unionByName(events), "event_id", "ts"), "deduplicated").select("event_id", "user_id")


def stream_triage(s, d):
    asked = T.as_messages(_stream(s, d, "conversations")).filter("inbound").select("tweet_id", "text")
    path = fresh_path(s, "triaged")
    S.triage_batches(asked, "tweet_id", "text", T.index(s, d), T.rule_classifier(s), T.HANDLE, path,
                     fresh_path(s, "triaged-log"), LIMITS).awaitTermination()
    return flat(s.read.parquet(path).drop("batch"), "tweet_id")


def _as_text(windows):
    return windows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


def escalation_rate_windows(s, d):
    return _as_text(M.escalation_windows(_flagged(T.table(s, d, "events")), "ts", "escalated", "6 hours"))


def _flagged(events):
    return events.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("value") > 80).alias("escalated"))


def stream_escalation_windows(s, d):
    """The windows that the watermark has closed when the stream is drained."""
    stream = S.escalation_windows(_flagged(_stream(s, d, "events")), "ts", "escalated", "6 hours", "1 hour")
    return _as_text(_drain(s, stream, "windows"))


# ---------------------------------------------------------------- dense vectors, several labels, near copies
def dense_topk(s, d):
    vectors = T.table(s, d, "embeddings")
    return DN.dense_topk(vectors, vectors.filter("vec_id % 20 = 0"), "vec_id", "embedding", 5)


def dense_topk_every_20(s, d):
    """The same search under its earlier name."""
    return dense_topk(s, d)


def multi_label_pessimistic(s, d):
    df = L.multi_label_pessimistic(T.customer_messages(s, d), "cleaned", T.taxonomy(s), T.KEYWORDS)
    return df.select("tweet_id", joined("intents").alias("intents"), joined("high_risk_intents").alias("high_risk_intents"),
                     "risk_level", "decision")


def leak_near_duplicates(s, d):
    """Documents of other sources that nearly repeat one of the first source."""
    docs = T.table(s, d, "documents")
    return LK.near_duplicates(docs.filter("source <> 'src0'"), "doc_id", "text", docs.filter("source = 'src0'"), "doc_id", "text")


def leak_near_benchmark(s, d):
    """Documents that hold most of a benchmark item."""
    return LK.near_duplicates(T.table(s, d, "documents"), "doc_id", "text", T.table(s, d, "benchmark"), "item_id", "text", contained=True)


# ---------------------------------------------------------------- sources and sinks, written and read back
def _written(s, df, write, read, *options):
    path = fresh_path(s, "sink")
    write(df, path, *options)
    return read(s, path, *options)


def read_tweets(s, d):
    path = fresh_path(s, "messages")
    SRC.write_tweets(T.messages(s, d), path, "csv")
    return SRC.read_tweets(s, path).select("tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id",
                                           F.col("in_response_to_tweet_id").cast("long").cast("string").alias("parent_id"))


def read_tweets_ranges(s, d):
    """The same file as in `read_tweets`, by byte ranges."""
    path = fresh_path(s, "messages")
    SRC.write_tweets(T.messages(s, d), path, "csv")
    return SRC.read_tweets_ranges(s, path).select("tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id",
                                                  F.col("in_response_to_tweet_id").cast("long").cast("string").alias("parent_id"))


def brand_sink(s, d):
    path = fresh_path(s, "subset")
    SRC.write_tweets(B.extract_brand(T.messages(s, d), T.BRAND), path)
    return s.read.parquet(path).select("tweet_id", "author_id", "inbound", "text")


def threads_sink(s, d):
    c = T.corpus(s, d)
    back = _written(s, D.nested_threads(c.turns, c.threads), SRC.write_threads, SRC.read_threads)
    return back.groupBy("conversation_id").agg(F.max("turn_count").alias("turn_count"), F.sum(F.size("turns")).alias("turns"),
                                               F.max("brand_first_response").alias("brand_first_response"))


def taxonomy_load(s, d):
    """The intents, enriched by how often each occurs, as one JSON document."""
    path = fresh_path(s, "taxonomy")
    counts = L.label_all_matches(T.customer_messages(s, d), "cleaned", T.KEYWORDS).select(F.explode("intents").alias("name")).groupBy("name").count()
    rows = T.taxonomy(s).drop("description", "resolution_patterns", "escalation_conditions").join(counts, "name", "left")
    rows = rows.withColumns({"description": F.concat_ws(" ", F.coalesce("count", F.lit(0)).cast("string"), F.lit("messages")),
                             "resolution_patterns": F.array("display_name"), "escalation_conditions": F.array("risk_level")})
    item = F.struct("priority", "name", "display_name", "risk_level", "default_action", "description", "examples",
                    "resolution_patterns", "escalation_conditions")
    rows.agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("intents")))).write.text(path)  # one row per intent
    back = SRC.read_taxonomy(s, path)
    return back.select("priority", "name", "display_name", "risk_level", "default_action", "description",
                       *[joined(c).alias(c) for c in ("examples", "resolution_patterns", "escalation_conditions")])


def held_out_ids(s, d):
    return _written(s, T.golden(s, d), SRC.write_held_out, SRC.read_held_out)


def golden_sink(s, d):
    return _written(s, T.golden(s, d), SRC.write_golden, SRC.read_golden)


def index_deltas(s, d):
    """An index that grew in steps: two thirds of the cases and some wrong ones, the rest, deletions, and a compaction between."""
    cases, path = materialize(T.cases(s, d), "cases"), fresh_path(s, "store")
    wrong = cases.withColumns({"case_order": -F.col("case_order") - 1, "case_id": F.concat(F.lit("wrong"), "case_id")})
    IS.append_cases(cases.filter("case_order % 3 <> 0").unionByName(wrong), path)
    IS.append_cases(cases.filter("case_order % 3 = 0").withColumn("customer_issue", F.lit("to be replaced")), path)
    IS.compact(s, path)
    IS.delete_cases(wrong, path)
    IS.append_cases(cases.filter("case_order % 3 = 0"), path)
    return R.search_topk(T.customer_messages(s, d), IS.open_index(s, path), "tweet_id", "cleaned", 3).select(
        "tweet_id", "rank", "case_id", "similarity_score")


def index_store(s, d):
    """The stored index, loaded again and searched."""
    path = fresh_path(s, "index")
    R.load_or_build_index(s, path, lambda: T.cases(s, d))
    loaded = R.load_or_build_index(s, path, lambda: None)
    return R.search_topk(T.customer_messages(s, d), loaded, "tweet_id", "cleaned", 3).select(
        "tweet_id", "rank", "case_id", "similarity_score")


def result_record(s, d):
    path = fresh_path(s, "record")
    parts = G.golden_distribution(T.golden(s, d))
    SRC.write_record(parts.agg(F.sort_array(F.collect_list(F.struct("facet", "value", "n"))).alias("parts")), path)
    return s.read.json(path).select(F.explode("parts").alias("p")).select("p.facet", "p.value", "p.n")


def blank_query(s, d):
    """Messages whose text is blank or missing get no rows."""
    text = F.when(F.col("tweet_id") % 3 == 0, " \t ").when(F.col("tweet_id") % 3 == 1, F.lit(None)).otherwise(F.col("cleaned"))
    asked = T.customer_messages(s, d).withColumn("cleaned", text)
    return R.search_topk(asked, T.index(s, d), "tweet_id", "cleaned", 1).select("tweet_id", "rank", "case_id", "similarity_score")


QUERIES = [
    validate_records, strip_control_chars, normalize_whitespace, strip_brand_mention, clean_brand_reply, assign_role,
    parse_created_at, parent_id, word_count, min_words, drop_acknowledgements,
    extract_brand, dedup_tweets, sort_tweets, extract_all_brands,
    first_child, conversation_roots, customer_roots, reply_chains, thread_filter, conversation_turns,
    conversation_threads, conversation_history,
    label_first_match, label_single_match, label_all_matches, label_documents, keyword_table_matches, intent_frequency, intent_samples,
    training_sample, taxonomy_join,
    tokenize_words, word_ngrams, char_wb_ngrams, strip_accents, vocabulary, vocabulary_top, idf, tfidf_weights, feature_union,
    majority_baseline, majority_quality, balanced_weights, predict_top2, class_probabilities, triggered_keywords,
    tfidf_baseline, hybrid_classifier, tfidf_baseline_certificate, hybrid_classifier_certificate, class_scores_fixed,
    build_cases, build_index, search_topk, search_by_intent, min_similarity, evidence_array,
    draft_reply, grounding_prompts, escalation_gates, escalation_gates_nulls, triage_rules, triage_default_limits, triage_model,
    stratified_sample, difficulty, gold_labels, ambiguous_sample, top_up, golden_set, golden_distribution,
    leak_duplicate_ids, leak_unregistered, leak_id_overlap, leak_text_overlap, leak_text_documents,
    leak_label_in_input, leakage_report,
    accuracy, per_class_prf, macro_prf, confusion_matrix, quality_prf, retrieval_metrics, first_relevant,
    escalation_safety, judge_scores, judge_summary, agreement_sample, rater_correlations,
    cohen_kappa, rater_agreement, failure_modes, model_comparison, majority_on_gold, evaluation_record,
    null_counts, direction_counts, brand_reply_counts, text_statistics, text_statistics_documents, text_statistics_sketched, date_range,
    brand_mentions, resolution_rich, conversation_estimate, vocabulary_diversity, vocabulary_diversity_sketched, sample_messages, brand_ranking,
    stream_clean_label, stream_dedup, stream_triage, escalation_rate_windows, stream_escalation_windows,
    dense_topk, dense_topk_every_20, multi_label_pessimistic, leak_near_duplicates, leak_near_benchmark,
    read_tweets, read_tweets_ranges, brand_sink, threads_sink, taxonomy_load, held_out_ids, golden_sink, index_store, index_deltas, result_record, blank_query,
]


def queries():
    return {q.__name__: q for q in QUERIES}
