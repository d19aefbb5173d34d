"""Dataset profile: nulls, directions, lengths, dates, and a suitability ranking of brands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import values as V
from ..functions import keywords as K
from ..functions import text as X
from ..session import is_small, materialize, measured, size_measures
from .brand import brand_mentions, known_brands


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def direction_counts(tweets: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return tweets.agg(
        total.alias("total_rows"), F.count_if("inbound").alias("inbound_count"),
        F.count_if(~F.col("inbound")).alias("outbound_count"),
        F.coalesce(F.round(F.count_if("inbound") / F.nullif(total, F.lit(0)), 4), F.lit(0.0)).alias("inbound_ratio"))


def brand_reply_counts(tweets: DataFrame, top: int | None = 30) -> DataFrame:
    counts = (tweets.filter(~F.col("inbound") & F.col("author_id").isNotNull())
              .groupBy(F.col("author_id").alias("brand")).agg(F.count(F.lit(1)).alias("outbound_brand_replies")))
    return counts if top is None else counts.orderBy(F.desc("outbound_brand_replies"), "brand").limit(top)


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Exact lengths in characters and words over all non-null texts.

    Rows are first counted per pair of lengths, so means and medians work on the counts.
    """
    sizes = df.filter(F.col(text).isNotNull()).select(
        F.length(text).alias("chars"), X.word_count(F.col(text)).alias("words"))
    counts = sizes.groupBy("chars", "words").agg(F.count(F.lit(1)).alias("n"))

    def mean(c: str) -> Column:
        return F.round(F.try_divide(F.sum(F.col(c) * F.col("n")), F.sum("n")), 2)

    return counts.agg(
        mean("chars").alias("char_length_mean"), F.percentile("chars", 0.5, F.col("n")).alias("char_length_median"),
        F.min("chars").alias("char_length_min"), F.max("chars").alias("char_length_max"),
        mean("words").alias("word_count_mean"), F.percentile("words", 0.5, F.col("n")).alias("word_count_median"))


def date_range(tweets: DataFrame) -> DataFrame:
    at = tweets.select(X.parse_created_at(F.col("created_at")).alias("at"))
    return at.agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def outbound_profile(tweets: DataFrame, words=None) -> DataFrame:
    """Per brand, its replies and those among them that contain one of the resolution words."""
    rich = K.has_keyword(F.col("text"), list(words or V.RESOLUTION_WORDS))
    return (tweets.filter(~F.col("inbound") & F.col("author_id").isNotNull())
            .groupBy(F.col("author_id").alias("brand"))
            .agg(F.count(F.lit(1)).alias("outbound_brand_replies"), F.count_if(rich).alias("resolution_rich_replies")))


def resolution_rich(tweets: DataFrame, words=None) -> DataFrame:
    return outbound_profile(tweets, words).drop("outbound_brand_replies")


def mention_counts(mentions: DataFrame) -> DataFrame:
    """Per brand, customer messages that mention it and those among them that start a conversation."""
    return mentions.groupBy("brand").agg(
        F.count(F.lit(1)).alias("inbound_customer_msgs"),
        F.count_if(F.col("in_response_to_tweet_id").isNull()).alias("first_contacts"))


def conversation_estimate(first_contacts: Column, outbound: Column) -> Column:
    return F.greatest(first_contacts, F.floor(outbound * V.CONVERSATION_SHARE))


def vocabulary_diversity(mentions: DataFrame) -> DataFrame:
    """Per brand, distinct words longer than three characters that do not start with @.

    Distinct (brand, word) pairs come first, so a brand with most of the messages is spread by word.
    """
    long_word = rf"(?<![^{X.SPACE}])[^{X.SPACE}@][^{X.SPACE}]{{3,}}"
    words = mentions.select("brand", F.explode(F.regexp_extract_all("text", F.lit(long_word), F.lit(0))).alias("word"))
    return (words.select("brand", F.lower("word").alias("word")).distinct()
            .groupBy("brand").agg(F.count(F.lit(1)).alias("customer_vocabulary_diversity")))


def sample_messages(mentions: DataFrame, tweets: DataFrame, k: int = 3) -> DataFrame:
    """Per brand, the first k customer messages by id. Only ids are ranked; their texts are fetched after."""
    place = F.row_number().over(Window.partitionBy("brand").orderBy("tweet_id"))
    picked = mentions.select("brand", "tweet_id").withColumn("sample_no", place).filter(F.col("sample_no") <= k)
    picked, sizes = measured(picked, "samples", **size_measures(picked))
    picked = F.broadcast(picked) if is_small(sizes) else picked
    return tweets.select("tweet_id", "text").join(picked, "tweet_id").select("brand", "sample_no", "tweet_id", "text")


def brand_ranking(tweets: DataFrame, top: int = 30, samples: int = 3) -> DataFrame:
    """Suitability of the `top` brands with the most replies, best first."""
    c = F.col
    profile = materialize(outbound_profile(tweets).orderBy(F.desc("outbound_brand_replies"), "brand").limit(top), "profile")
    # at most `top` brands, so the mentions meet them in a broadcast
    brands = known_brands(tweets).join(F.broadcast(profile.select("brand")), "brand", "left_semi")
    # written once: three statistics follow
    mentions = materialize(brand_mentions(tweets, brands, small=True).select("brand", "tweet_id", "text", "in_response_to_tweet_id"), "mentions")
    stats = (profile.join(mention_counts(mentions), "brand", "left")
             .join(vocabulary_diversity(mentions), "brand", "left")
             .join(sample_messages(mentions, mentions.drop("brand").dropDuplicates(["tweet_id"]), samples).groupBy("brand").agg(
                 F.array_sort(F.collect_list(F.struct("sample_no", "text"))).alias("s")), "brand", "left")
             .na.fill(0))
    table = stats.withColumn("total_messages", c("outbound_brand_replies") + c("inbound_customer_msgs")).withColumn(
        "estimated_conversations", conversation_estimate(c("first_contacts"), c("outbound_brand_replies")))
    score = sum((F.least(c(m) / F.lit(float(full)), F.lit(1.0)) * weight for m, full, weight in V.SCORE_PARTS),
                F.lit(0.0))
    return table.select(
        "brand", "total_messages", "outbound_brand_replies", "inbound_customer_msgs", "estimated_conversations",
        "resolution_rich_replies", "customer_vocabulary_diversity", F.round(score, 2).alias("suitability_score"),
        F.coalesce(c("s.text"), F.array().cast("array<string>")).alias("sample_customer_issues")).orderBy(
        F.desc("suitability_score"), "brand")
