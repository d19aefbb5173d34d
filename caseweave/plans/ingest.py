"""From raw messages to threads of one brand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import brand as B
from ..operators import threads as D
from ..session import materialize


@dataclass
class Corpus:
    tweets: DataFrame
    turns: DataFrame
    threads: DataFrame


def brand_subset(tweets: DataFrame, brand: str) -> DataFrame:
    return B.dedup_tweets(B.extract_brand(tweets, brand))


def ingest(tweets: DataFrame, brand: str, min_turns: int = 2, id_prefix: str = "conv_") -> Corpus:
    """Extract, deduplicate and rebuild threads. The tables that are read again are written once."""
    subset = materialize(brand_subset(tweets, brand), "tweets")
    turns = materialize(D.conversation_turns(subset, brand, min_turns), "turns")
    return Corpus(subset, turns, materialize(D.conversation_threads(turns, id_prefix), "threads"))
