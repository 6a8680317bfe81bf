"""Live fraud counts per minute of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.functions.predicates import is_fraud
from riskstream.sources.tables import TableStore

#: How long after the newest event an older one still counts.
LATENESS = "10 minutes"
MINUTE = "1 minute"


def fraud_windows(transactions: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """``minute, fraud_count`` of a stream of stored transactions, in windows of event time.

    Windows are kept until the watermark passes them, and so are the ids of frauds: a run that is written
    again shows its rows again, and they count once. An event older than the watermark comes too late and
    is left out. Of a batch frame the result is that of all its rows.
    """
    # a watermark needs a zoned time: the session's zone, UTC in ours, is put on and taken off again
    time = F.col("transaction_timestamp").cast("timestamp").alias("event_time")
    timed = transactions.filter(is_fraud()).select("transaction_id", time).withWatermark("event_time", lateness)
    key = ["transaction_id"]
    once = timed.dropDuplicatesWithinWatermark(key) if timed.isStreaming else timed.dropDuplicates(key)
    counted = once.groupBy(F.window("event_time", MINUTE)).agg(F.count(F.lit(1)).alias("fraud_count"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "fraud_count")


def start_timeline(
    transactions: DataFrame, store: TableStore, checkpoint: str, lateness: str = LATENESS, **trigger
) -> StreamingQuery:
    """Keep the table ``fraud_minutes`` up to date: one row a minute, its count replaced whenever it changes."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert("fraud_minutes", batch, ["minute"])

    stream = fraud_windows(transactions, lateness).writeStream.foreachBatch(write).outputMode("update")
    stream = stream.option("checkpointLocation", checkpoint)
    return (stream.trigger(**trigger) if trigger else stream).start()


def fraud_timeline(store: TableStore) -> DataFrame:
    """``minute, fraud_count`` as of now."""
    return store.read("fraud_minutes")
