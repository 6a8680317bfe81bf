"""From message bytes to typed, complete events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.predicates import REQUIRED_FIELDS, has_required_fields
from riskstream.schemas import EVENT, MODEL_FEATURES, MONEY_BOUND

# --- fixed values: time layout, and the spend assumed for users without history ---
TIMESTAMP_LAYOUT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
DEFAULT_USER_AVERAGE = 200.0
# --- end of fixed values ---


def message_text(messages: DataFrame) -> DataFrame:
    """Message payload as text, in a column ``body``."""
    return messages.select(F.col("value").cast("string").alias("body"))


def parse_events(bodies: DataFrame, keep_body: bool = False) -> DataFrame:
    """JSON text to the declared event columns; unreadable text gives all nulls.

    The struct is flattened by a generator rather than by ``select("event.*")``: filters are not
    pushed below a generator, so each message is parsed once. Through a projection they are, and
    then the parse is repeated for every reference to one of its fields.
    """
    kept = ["body"] if keep_body else []
    return bodies.select(*kept, F.inline(F.array(F.from_json("body", EVENT))))


def event_time(text: str = "timestamp") -> Column:
    """Zone-free event time.

    The text carries no zone, so the value has none either and the hour rule cannot move
    with the session's zone. Another layout or an impossible date gives null.
    """
    return F.when(F.col(text).rlike(TIMESTAMP_LAYOUT), F.col(text).try_cast("timestamp_ntz"))


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", event_time())


def average_or_default() -> Column:
    return F.coalesce(F.col("user_avg_amount"), F.lit(DEFAULT_USER_AVERAGE))


def spend_ratio(use_supplied_average: bool = False) -> Column:
    """Supplied ratio, else the amount over the default average.

    By default a supplied average does not change the fallback ratio;
    ``use_supplied_average`` divides by it instead.
    """
    base = F.greatest(average_or_default(), F.lit(1.0)) if use_supplied_average else F.lit(DEFAULT_USER_AVERAGE)
    return F.coalesce(F.col("amount_vs_avg_user"), F.col("amount") / base)


def with_spend_defaults(events: DataFrame, use_supplied_average: bool = False) -> DataFrame:
    return events.withColumns(
        {
            "user_avg_amount": average_or_default(),
            "amount_vs_avg_user": spend_ratio(use_supplied_average),
        }
    )


def fill_features(events: DataFrame) -> DataFrame:
    """Absent or NaN model inputs become 0.0 (``Amount`` is the event's own amount)."""
    inputs = [name for name in MODEL_FEATURES if name != "Amount"]
    return events.na.fill(0.0, subset=[*inputs, "amount"])


def reject_reason() -> Column:
    """Why an event cannot be scored, or null when it can.

    NaN amounts and amounts beyond the storage type are turned away here: scored, they
    would either count as zero spend or stop the stream at the table write.
    """
    unreadable = F.coalesce(*[F.col(c).cast("string") for c in REQUIRED_FIELDS]).isNull()
    return (
        F.when(has_required_fields() & ~F.isnan("amount") & (F.abs("amount") < MONEY_BOUND), None)
        .when(unreadable, "unreadable_message")
        .when(F.col("transaction_id").isNull(), "missing_transaction_id")
        .when(F.col("user_id").isNull(), "missing_user_id")
        .when(F.col("amount").isNull(), "missing_amount")
        .when(F.col("event_time").isNull(), "bad_timestamp")
        .when(F.isnan("amount"), "amount_not_a_number")
        .otherwise("amount_out_of_range")
    )


def judged_events(bodies: DataFrame) -> DataFrame:
    """Every message parsed once: event columns, ``event_time``, ``reject_reason``, and the body of rejected ones."""
    timed = with_event_time(parse_events(bodies, keep_body=True)).withColumn("reject_reason", reject_reason())
    return timed.withColumn("body", F.when(F.col("reject_reason").isNotNull(), F.col("body")))


def ready_events(events: DataFrame, use_supplied_average: bool = False) -> DataFrame:
    """Defaults for what a scorer needs."""
    return fill_features(with_spend_defaults(events, use_supplied_average))


def accepted_events(bodies: DataFrame, use_supplied_average: bool = False) -> DataFrame:
    """Complete, typed events ready for scoring."""
    complete = judged_events(bodies).filter("reject_reason IS NULL").drop("body", "reject_reason")
    return ready_events(complete, use_supplied_average)


def rejected_events(bodies: DataFrame) -> DataFrame:
    """The messages :func:`accepted_events` leaves out, whole, with the reason."""
    return judged_events(bodies).filter("reject_reason IS NOT NULL").select("body", "reject_reason")
