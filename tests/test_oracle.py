"""Registered queries against their SQL twins on the smallest tables. ORACLE_ALL=1 runs every one."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
CORE = ["dedup_tweets", "conversation_threads", "label_all_matches", "intent_frequency", "char_wb_ngrams", "tfidf_weights",
        "build_index", "search_by_intent", "min_similarity", "grounding_prompts", "escalation_gates", "triage_rules",
        "golden_set", "confusion_matrix", "escalation_safety", "rater_agreement", "brand_ranking"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ORACLE_ALL") else CORE)
def test_query(spark, duck, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    assert compare(mine, duck.execute(entry.oracle_sql()[name]).df()) == "ok"
