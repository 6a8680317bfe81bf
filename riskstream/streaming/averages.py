"""What users spent before, kept along the stream of stored transactions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.operators.dedupe import drop_repeats
from riskstream.operators.enrich import spend_totals, with_running_average
from riskstream.schemas import SPEND_PROFILES, USER_SPEND
from riskstream.sources.tables import TableStore


def start_averages(transactions: DataFrame, store: TableStore, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep ``spend_profiles``, a row for each stored transaction with its user's average until then.

    A batch joins what its users spent in earlier batches, and adds its own totals to ``user_spend`` as a run,
    which a replay of the batch replaces; rows of a batch follow one another by time. A transaction
    that a replayed scoring run shows again counts once. If batches arrive in the order of their times the result
    is that of :func:`with_running_average` over all rows; a late row is compared with all that arrived before it.
    """
    columns = ["transaction_id", "user_id", F.col("transaction_timestamp").alias("event_time"), F.col("amount").cast("double")]
    once = drop_repeats(transactions.select(*columns))

    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"averages-{batch_id}"
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            users = batch.select("user_id").distinct()
            earlier = store.partitions("user_spend").filter(F.col("run") != run).join(users, "user_id", "left_semi")
            carried = earlier.groupBy("user_id").agg(F.sum("spent").alias("spent"), F.sum("row_count").alias("row_count"))
            averaged = with_running_average(batch, carried)
            totals = spend_totals(batch).withColumn("until", F.lit(batch.agg(F.max("event_time")).first()[0]).cast("timestamp_ntz"))
            store.write_run(run, {"spend_profiles": averaged.select(*SPEND_PROFILES.names)})
            store.write_run(run, {"user_spend": totals.select(*USER_SPEND.names)}, one_day=True)
        finally:
            batch.unpersist()

    stream = once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(**trigger) if trigger else stream).start()
