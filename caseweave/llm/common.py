"""Tables, vocabulary files and small pieces that several operators share."""

from __future__ import annotations

import base64
import functools
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import is_small, lookup_join, materialize, measured, size_measures, work_folder  # noqa: F401


_sent: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Send this package to the workers, once an application, as `--py-files` would. The archive is made where the
    driver runs and served by it; no shared folder is needed."""
    application = spark.sparkContext.applicationId
    if application not in _sent:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="code-"), os.path.basename(package))
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
        _sent.add(application)


def in_files(df: DataFrame, rows: int, per_file: int = 250_000) -> DataFrame:
    """Before a write of about `rows` rows: so many tasks that each writes `per_file`, instead of many small files."""
    return df.coalesce(max(1, -(-rows // per_file)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text with null as empty, without the other columns except those named."""
    send_code(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *more)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def vocabulary_file(name: str) -> str:
    """Where the machine at hand keeps a public vocabulary file; call it where the file is opened."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def bpe_encoder(path: str | None = None):
    """A byte-level BPE encoder from a rank file (default byte_bpe_50k), one per worker process."""
    import public_tokenizers
    import tiktoken

    with open(path or vocabulary_file("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(texts, path: str | None = None) -> list[int]:
    encoder = bpe_encoder(path)
    return [len(encoder.encode_ordinary(t)) for t in texts]


def join_lookup(left: DataFrame, side: DataFrame, key: str, how: str = "left", salts: int = 64) -> DataFrame:
    """Join to a table with unique keys, written and measured first: broadcast if it is small, else salted."""
    side, sizes = measured(side, "lookup", **size_measures(side))
    return lookup_join(left, side, key, how, salts, small=is_small(sizes))
