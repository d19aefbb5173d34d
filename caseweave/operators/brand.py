"""Which messages belong to a brand: validation, extraction, deduplication, order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as X
from ..session import lookup_join


def validate_records(tweets: DataFrame) -> DataFrame:
    """Keep rows with an id, a non-blank author and a non-blank text."""
    return tweets.filter(
        F.col("tweet_id").isNotNull() & ~X.is_blank(F.col("author_id")) & ~X.is_blank(F.col("text")))


def extract_brand(tweets: DataFrame, brand: str) -> DataFrame:
    """Replies written by the brand and customer messages whose text holds '@brand'."""
    name = brand.lower()
    sent = ~F.col("inbound") & (F.lower("author_id") == name)
    addressed = F.col("inbound") & F.lower("text").contains("@" + name)
    return tweets.filter(F.coalesce(sent | addressed, F.lit(False)))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when a table is empty, as an extraction for an unknown brand must."""
    if df.isEmpty():
        raise ValueError(f"no interactions found for {what}")
    return df


def dedup_tweets(tweets: DataFrame) -> DataFrame:
    """One row per tweet_id: the smallest by the remaining columns.

    min() of a struct combines before the shuffle, so an id with very many copies stays cheap.
    """
    rest = [c for c in tweets.columns if c != "tweet_id"]
    first = tweets.groupBy("tweet_id").agg(F.min(F.struct(*rest)).alias("row"))
    return first.select("tweet_id", "row.*").select(tweets.columns)


def sort_tweets(tweets: DataFrame) -> DataFrame:
    return tweets.orderBy("tweet_id")


def known_brands(tweets: DataFrame) -> DataFrame:
    """Authors of outbound messages. When two spellings differ in case only, the smaller one is kept."""
    return (tweets.filter(~F.col("inbound") & F.col("author_id").isNotNull())
            .groupBy(F.lower("author_id").alias("handle")).agg(F.min("author_id").alias("brand")))


def brand_mentions(tweets: DataFrame, brands: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """One row per customer message and known brand that it mentions.

    `brands` (handle, brand) limits the brands; `small` says that it is known to fit a broadcast.
    """
    brands = known_brands(tweets) if brands is None else brands
    handles = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(X.MENTION), F.lit(1)))
    mentions = (tweets.filter(F.col("inbound") & F.col("text").contains("@"))
                .select("*", F.explode(handles).alias("handle")))
    return lookup_join(mentions, brands, "handle", small=small).drop("handle")


def extract_all_brands(tweets: DataFrame) -> DataFrame:
    """Every brand's own messages and the customer messages that mention it, in one pass per side."""
    sent = tweets.filter(~F.col("inbound") & F.col("author_id").isNotNull()).withColumn("brand", F.col("author_id"))
    return sent.unionByName(brand_mentions(tweets))
