"""Reply threads: who answers whom, chains from root to leaf, one row per thread.

A message has at most one parent, and of its replies only the smallest id is followed. The
followed links therefore form separate paths (and cycles, which have no root). Chains are
resolved by pointer doubling: each round every message looks at the message its pointer names and
takes over that message's pointer, so a path of length L is done after about log2(L) rounds and
all join keys are unique on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import text as X
from ..session import materialize, measured, small_side

# A parent with more replies than this is joined by broadcast. At most rows/HOT_REPLIES such parents exist.
HOT_REPLIES = 1_000_000
# Threads longer than this are spread over SLOTS tasks. At most rows/LONG_THREAD such threads exist.
LONG_THREAD = 1_000_000
SLOTS = 64


def reply_links(tweets: DataFrame, brand: str) -> DataFrame:
    """The narrow link table that the thread operators work on."""
    return tweets.select(
        "tweet_id",
        X.parent_id(F.col("in_response_to_tweet_id")).alias("parent_id"),
        X.assign_role(F.col("inbound"), F.col("author_id"), brand).alias("role"))


def first_child(links: DataFrame) -> DataFrame:
    """For every parent id, the smallest reply id and the number of replies."""
    return (links.filter(F.col("parent_id").isNotNull()).groupBy("parent_id")
            .agg(F.min("tweet_id").alias("first_child"), F.count(F.lit(1)).alias("replies")))


def conversation_roots(links: DataFrame, hot_replies: int = HOT_REPLIES) -> DataFrame:
    """Messages without a parent, or whose parent is not in the data.

    The parents are reduced to one row each before they meet the ids. Parents with very many
    replies are handled by a broadcast of those few ids; the rest meets in a plain semi join.
    """
    parents = materialize(first_child(links), "parents")
    ids = links.select(F.col("tweet_id").alias("parent_id"))
    missing = parents.join(ids, "parent_id", "left_anti")
    hot = small_side(parents.filter(F.col("replies") > hot_replies).select("parent_id"), "hotparents")
    hot_missing = small_side(missing.filter(F.col("replies") > hot_replies).select("parent_id"), "hotmissing")
    cold_missing = missing.filter(F.col("replies") <= hot_replies).select("parent_id")
    replies = links.filter(F.col("parent_id").isNotNull())
    return (links.filter(F.col("parent_id").isNull())
            .unionByName(replies.join(hot_missing, "parent_id", "left_semi").select(links.columns))
            .unionByName(replies.join(hot, "parent_id", "left_anti")
                         .join(cold_missing, "parent_id", "left_semi").select(links.columns)))


def customer_roots(links: DataFrame) -> DataFrame:
    return conversation_roots(links).filter(F.col("role") == "customer")


def reply_chains(links: DataFrame) -> DataFrame:
    """(root_tweet_id, turn_index, tweet_id, role) for every message on a customer's main chain."""
    links = materialize(links, "links")
    roots = customer_roots(links).select("tweet_id", F.lit(True).alias("is_root"))
    followed = (first_child(links)
                .join(links.select(F.col("tweet_id").alias("parent_id")), "parent_id", "left_semi")
                .select(F.col("first_child").alias("tweet_id"), F.col("parent_id").alias("pointer")))
    start = (links.join(followed, "tweet_id", "left").join(roots, "tweet_id", "left").select(
        "tweet_id", "role",
        F.coalesce("pointer", "tweet_id").alias("pointer"),
        F.when(F.col("pointer").isNull(), 0).otherwise(1).alias("steps"),
        F.col("pointer").isNull().alias("done"),
        F.coalesce("is_root", F.lit(False)).alias("from_root")))
    still_open = F.count_if(~F.col("done"))
    state, seen = measured(start, "chains", open=still_open)
    open_rows = seen["open"]
    finished, moving = [state.filter("done")], state.filter("NOT done")
    while open_rows:
        # every row's state is in one of the tables; only those still open are written again
        ahead = reduce(DataFrame.unionByName, [*finished, moving]).select(
            F.col("tweet_id").alias("pointer"), F.col("pointer").alias("next"), F.col("steps").alias("more"),
            F.col("done").alias("there"), F.col("from_root").alias("rooted"))
        moved, seen = measured(moving.join(ahead, "pointer").select(
            "tweet_id", "role", F.col("next").alias("pointer"), (F.col("steps") + F.col("more")).alias("steps"),
            F.col("there").alias("done"), F.col("rooted").alias("from_root")), "chains", open=still_open)
        finished, moving = [*finished, moved.filter("done")], moved.filter("NOT done")
        if seen["open"] == open_rows:
            break  # every path gets shorter each round, so only cycles are left, and they have no root
        open_rows = seen["open"]
    state = reduce(DataFrame.unionByName, finished)
    return state.filter("done AND from_root").select(
        F.col("pointer").alias("root_tweet_id"), (F.col("steps") + 1).alias("turn_index"), "tweet_id", "role")


def thread_sizes(chains: DataFrame) -> DataFrame:
    return chains.groupBy("root_tweet_id").agg(
        F.count(F.lit(1)).alias("turn_count"), F.count_if(F.col("role") == "brand").alias("brand_turns"))


def thread_filter(chains: DataFrame, min_turns: int = 2) -> DataFrame:
    """Roots of threads with enough messages and at least one brand message."""
    return thread_sizes(chains).filter((F.col("turn_count") >= min_turns) & (F.col("brand_turns") > 0))


def kept_chains(chains: DataFrame, min_turns: int = 2) -> DataFrame:
    """Messages of the kept threads. A very long thread is spread over SLOTS tasks by message id."""
    is_long = F.col("turn_count") > LONG_THREAD
    slots = F.when(is_long, F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(F.array(F.lit(0)))
    kept = thread_filter(chains, min_turns).select("root_tweet_id", F.explode(slots).alias("slot"))
    long_roots = small_side(thread_sizes(chains).filter(is_long)
                            .select("root_tweet_id", F.lit(True).alias("is_long")), "longroots")
    slot = F.when(F.col("is_long"), F.pmod(F.xxhash64("tweet_id"), F.lit(SLOTS)).cast("int")).otherwise(F.lit(0))
    return (chains.join(long_roots, "root_tweet_id", "left").withColumn("slot", slot)
            .join(kept, ["root_tweet_id", "slot"], "left_semi").select(chains.columns))


def conversation_turns(tweets: DataFrame, brand: str, min_turns: int = 2) -> DataFrame:
    """One row per message of every kept thread, with its place and its cleaned text."""
    chains = reply_chains(reply_links(tweets, brand))
    placed = kept_chains(chains, min_turns)
    cleaned = F.when(F.col("role") == "brand", X.clean_brand_reply(F.col("text"))).otherwise(
        X.clean_customer_text(F.col("text"), "@" + brand))
    return placed.join(tweets, "tweet_id").select(
        "root_tweet_id", "turn_index", "tweet_id", "author_id", "role",
        F.coalesce("text", F.lit("")).alias("text"), cleaned.alias("cleaned_text"),
        F.coalesce(F.col("created_at").cast("string"), F.lit("")).alias("created_at"),
        X.parent_id(F.col("in_response_to_tweet_id")).alias("in_response_to_tweet_id"))


def conversation_threads(turns: DataFrame, id_prefix: str = "conv_") -> DataFrame:
    """One flat row per thread. All aggregates combine before the shuffle."""
    is_brand = F.col("role") == "brand"
    at = F.col("turn_index")
    at_root, at_brand = F.when(at == 1, at), F.when(is_brand, at)
    return (turns.groupBy("root_tweet_id").agg(
        F.min_by("author_id", at_root).alias("customer_author_id"),
        F.count(F.lit(1)).alias("turn_count"),
        F.min_by("text", at_root).alias("customer_initial_issue"),
        F.min_by("cleaned_text", at_root).alias("customer_cleaned_issue"),
        F.min_by("cleaned_text", at_brand).alias("brand_first_response"),
        F.max_by("cleaned_text", at_brand).alias("brand_final_resolution"),
        F.max(is_brand).alias("has_brand_resolution"))
        .withColumn("conversation_id", F.concat(F.lit(id_prefix), F.col("root_tweet_id").cast("string"))))


def nested_threads(turns: DataFrame, threads: DataFrame, part_turns: int = 10_000) -> DataFrame:
    """Threads with their turns as an array, for the JSON form.

    A thread longer than `part_turns` continues on further rows (`part` 0, 1, ...), so no row and
    no group grows without bound and no turn is lost.
    """
    nested = (turns.withColumn("part", F.floor((F.col("turn_index") - 1) / part_turns))
              .groupBy("root_tweet_id", "part")
              .agg(F.array_sort(F.collect_list(F.struct(
                  F.col("turn_index").cast("int").alias("turn_index"), "tweet_id", "author_id", "role", "text",
                  "cleaned_text", "created_at", "in_response_to_tweet_id"))).alias("turns")))
    return nested.join(threads, "root_tweet_id").select(
        "conversation_id", "root_tweet_id", "customer_author_id", "turn_count", "part", "turns",
        "customer_initial_issue", "customer_cleaned_issue", "brand_first_response", "brand_final_resolution",
        "has_brand_resolution")


def conversation_history(turns: DataFrame, brand: str, up_to: int | None = None,
                         part_turns: int = 10_000) -> DataFrame:
    """Readable dialog text of the first `up_to` turns, in parts of bounded length."""
    speaker = F.when(F.col("role") == "customer", "Customer").otherwise(f"Support ({brand})")
    shown = turns if up_to is None else turns.filter(F.col("turn_index") <= up_to)
    lines = shown.select(
        "root_tweet_id", F.floor((F.col("turn_index") - 1) / part_turns).alias("part"), "turn_index",
        F.concat_ws(": ", speaker, F.col("cleaned_text")).alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("turn_index", "line")))
    return (lines.groupBy("root_tweet_id", "part").agg(ordered.alias("lines"))
            .select("root_tweet_id", "part", F.array_join(F.col("lines.line"), "\n").alias("history")))
