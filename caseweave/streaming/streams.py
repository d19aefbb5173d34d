"""The same operators over a stream of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import values as V
from ..functions import keywords as K
from ..functions import text as X
from ..operators.metrics import escalation_windows as windows
from ..plans import triage as T
from ..session import materialize


def clean_label(stream: DataFrame, brand: str, dictionary=V.CORE_KEYWORDS,
                default: str = V.DEFAULT_INTENT) -> DataFrame:
    """Role, cleaned text and first-match intent of every incoming message; stateless."""
    role = X.assign_role(F.col("inbound"), F.col("author_id"), brand)
    cleaned = F.when(role == "brand", X.clean_brand_reply(F.col("text"))).otherwise(
        X.clean_customer_text(F.col("text"), "@" + brand))
    return stream.select("tweet_id", role.alias("role"), cleaned.alias("cleaned_text")).withColumn(
        "intent", K.first_match(F.col("cleaned_text"), dictionary, default))


def dedup(stream: DataFrame, key: str, at: str, delay: str = "1 hour") -> DataFrame:
    """One row per key among rows that arrive within the watermark delay; state is dropped after it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def escalation_windows(stream: DataFrame, at: str, escalated: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Escalation volume and rate per window; a window comes out once the watermark has passed its end."""
    return windows(stream, at, escalated, width, delay)


def triage_batches(stream: DataFrame, key: str, text: str, index, classifier: T.Classifier, handle: str, path: str,
                   checkpoint: str, limits: T.Thresholds = T.Thresholds()):
    """Triage every micro-batch into a Parquet table.

    Each batch writes its own folder and overwrites it when replayed, so a restart adds no rows twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch, "batch")  # read by the classifier, the search and the joins
        T.triage(batch, key, text, index, classifier, handle, limits).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_to_table(stream: DataFrame, path: str, checkpoint: str):
    """Process what is available into a Parquet table and stop."""
    return (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
