"""Schemas of the tables that enter and leave the engine."""

from pyspark.sql import types as T

# One message. The parent link is written as a float by many exports.
TWEETS = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.BooleanType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("response_tweet_id", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.DoubleType()),
])

TURN = T.StructType([
    T.StructField("turn_index", T.IntegerType()),
    T.StructField("tweet_id", T.LongType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.LongType()),
])

THREADS = T.StructType([
    T.StructField("conversation_id", T.StringType()),
    T.StructField("root_tweet_id", T.LongType()),
    T.StructField("customer_author_id", T.StringType()),
    T.StructField("turn_count", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("turns", T.ArrayType(TURN)),
    T.StructField("customer_initial_issue", T.StringType()),
    T.StructField("customer_cleaned_issue", T.StringType()),
    T.StructField("brand_first_response", T.StringType()),
    T.StructField("brand_final_resolution", T.StringType()),
    T.StructField("has_brand_resolution", T.BooleanType()),
])

GOLDEN = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("conversation_id", T.StringType()),
    T.StructField("customer_message", T.StringType()),
    T.StructField("conversation_context", T.StringType()),
    T.StructField("gold_intent", T.StringType()),
    T.StructField("gold_decision", T.StringType()),
    T.StructField("gold_reason", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("reference_resolution", T.StringType()),
    T.StructField("difficulty", T.StringType()),
    T.StructField("turn_count", T.LongType()),
])

TAXONOMY = T.StructType([
    T.StructField("priority", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("default_action", T.StringType()),
    T.StructField("examples", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("resolution_patterns", T.ArrayType(T.StringType())),
    T.StructField("escalation_conditions", T.ArrayType(T.StringType())),
])
