"""The scoring stream: parse, drop repeats, score and fan out to the result tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.functions.cleaning import accepted_events, message_text, rejected_events
from riskstream.functions.decision import with_decision
from riskstream.functions.projections import alert_rows, risk_score_rows, transaction_rows
from riskstream.functions.rules import RULES, with_rule_scores
from riskstream.operators.dedupe import drop_repeats, drop_stored
from riskstream.operators.quality import write_checked
from riskstream.schemas import REJECTED, TRANSACTIONS
from riskstream.sources.models import Scorer
from riskstream.sources.tables import TableStore

# What the tables need of a scored event; model inputs are spent by then.
KEPT = tuple(
    dict.fromkeys(
        name for name in (*TRANSACTIONS.names, *RULES, "event_time") if name not in ("transaction_timestamp",)
    )
)


def score_messages(messages: DataFrame, scorer: Scorer, processed_at: Column | None = None) -> DataFrame:
    """Messages to scored events, stateless; the same for batch and stream."""
    events = accepted_events(message_text(messages))
    return with_decision(scorer(with_rule_scores(events)), processed_at)


def arrival() -> Column:
    """The time of the batch that a row arrives in: a stream logs it, so a replayed batch has the same."""
    return F.current_timestamp()


def prepared(messages: DataFrame, within: str | None = None, received_at: Column | None = None) -> DataFrame:
    """Accepted events, one per transaction id, with the time they arrived.

    A stream remembers the ids that it has seen, and nothing else: for as long as it lives, or for the time
    ``within`` after their arrival, when copies never come later than that. Messages that cannot be scored
    take no part; :func:`start_rejects` stores them.
    """
    events = accepted_events(message_text(messages))
    received = events.withColumn("received_at", arrival() if received_at is None else received_at)
    return drop_repeats(received, "transaction_id", within, "received_at")


def scored_tables(scored: DataFrame, fixed_point_messages: bool = False) -> dict[str, DataFrame]:
    """Rows for each result table, transactions last; as many passes over ``scored``, which the caller caches if it is costly."""
    return {
        "risk_scores": risk_score_rows(scored),
        "fraud_alerts": alert_rows(scored, fixed_point_messages),
        "transactions": transaction_rows(scored),
    }


def fan_out(
    scored: DataFrame, store: TableStore, run_id: str, fixed_point_messages: bool = False, one_day: bool = False
) -> None:
    """Write a scored batch to the result tables as one replaceable run, with its counts of faulty rows."""
    write_checked(store, run_id, scored_tables(scored, fixed_point_messages), one_day)


class BatchWriter:
    """The ``foreachBatch`` function of the scoring stream, for batches of :func:`prepared` messages.

    The stream's state keeps ids unique among its own batches. Ids that other owners have stored (other
    streams, or this one before its checkpoint was lost) are dropped before the model sees them; a
    stream without others never reads what is stored. A run is named after the query and the batch, so two
    streams never share one and a replay replaces its own.
    """

    def __init__(
        self,
        store: TableStore,
        scorer: Scorer,
        processed_at: Column | None = None,
        fixed_point_messages: bool = False,
        owner: str = "direct",
    ):
        self.store = store
        self.scorer = scorer
        self.processed_at = processed_at
        self.fixed_point_messages = fixed_point_messages
        self.owner = owner

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        owner = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or self.owner
        others = self.store.other_owners(owner)
        if others:  # the batch is compared before it is scored, so it is held in full
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        new = drop_stored(batch, self.store.read("transactions", other_than=owner)) if others else batch
        scored = self._scored(new).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not scored.isEmpty():
                fan_out(scored, self.store, f"{owner}-{batch_id}", self.fixed_point_messages, one_day=True)
        finally:
            scored.unpersist()
            if others:
                batch.unpersist()

    def _scored(self, batch: DataFrame) -> DataFrame:
        """The columns that the tables need of every row, scored; by default processed when they arrived."""
        arrived = F.col("received_at").cast("timestamp_ntz")
        scored = with_decision(
            self.scorer(with_rule_scores(batch)), arrived if self.processed_at is None else self.processed_at
        )
        return scored.select(*KEPT)


def _started(stream, checkpoint: str, trigger: dict) -> StreamingQuery:
    stream = stream.outputMode("append").option("checkpointLocation", checkpoint)
    return (stream.trigger(**trigger) if trigger else stream).start()


def start_scoring(
    messages: DataFrame, writer: BatchWriter, checkpoint: str, within: str | None = None, **trigger
) -> StreamingQuery:
    """Start the stream; ``within`` bounds its memory of ids and ``trigger`` is passed on, e.g. ``availableNow=True``.

    Seen ids outgrow memory, so the state store is RocksDB unless the session names another.
    """
    conf, store = messages.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if conf.get(store, None) is None or conf.get(store).endswith("HDFSBackedStateStoreProvider"):
        conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return _started(prepared(messages, within).writeStream.foreachBatch(writer), checkpoint, trigger)


def start_rejects(
    messages: DataFrame, store: TableStore, checkpoint: str, rejected_at: Column | None = None, **trigger
) -> StreamingQuery:
    """Start the stream of messages that cannot be scored, whole and with a reason; it has no state."""
    stamp = arrival().cast("timestamp_ntz") if rejected_at is None else rejected_at
    rejected = rejected_events(message_text(messages)).withColumn("rejected_at", stamp).select(*REJECTED.names)

    def write(batch: DataFrame, batch_id: int) -> None:
        owner = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store.write_run(f"{owner}-{batch_id}", {"rejected_messages": batch}, one_day=True)

    return _started(rejected.writeStream.foreachBatch(write), checkpoint, trigger)
