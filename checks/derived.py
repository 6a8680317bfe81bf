"""Payment events, labels and profiles derived from a star schema of events and customers.

Stands in for a live topic and a card data set: every input row becomes one output row, so
work grows with the tables. The constants only give the derived columns their variety.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.functions.decision import with_decision
from riskstream.functions.predicates import is_alertable
from riskstream.functions.projections import alert_rows, transaction_rows
from riskstream.functions.rules import with_rule_scores
from riskstream.operators.enrich import SMALLEST_AVERAGE
from riskstream.operators.lookup import lookup
from riskstream.schemas import FRAUD, LABEL, LABELLED, PROBABILITY, SIGNAL_FIELDS, TRANSACTIONS, USERS
from riskstream.session import durable

CATEGORIES = ("Crypto", "Luxury", "Grocery", "Restaurant", "Electronics", "Transport", "Pharmacy")
PAYMENT_METHODS = ("Credit Card", "Debit Card", "Mobile Wallet", "Bank Transfer")


# Columns used of each input table.
INPUTS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "embeddings": "vec_id bigint, embedding array<float>",
}


def input_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(INPUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Rows that one task takes at most of a table, however its files are cut into row groups.
ROWS_PER_TASK = 100_000


def spread(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` dealt out to tasks of equal size, as many as their number asks for.

    A scan has as many tasks as a file has row groups, and one may hold millions of rows. The count of a
    Parquet table reads its footers only. Rows are moved while they are narrow; few rows stay where they are.
    """
    tasks = -(-rows.count() // rows_per_task)
    return rows.repartition(tasks) if tasks > 1 else rows


def _cycle(n: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def probability_of(n: Column) -> Column:
    """A supplied probability, mostly small: ((n*7919 mod 1000) / 1000) to the eighth power."""
    p0 = ((n * 7919) % 1000).cast("double") / 1000.0
    square = p0 * p0
    fourth = square * square
    return fourth * fourth


def probability_from_id(events: DataFrame) -> DataFrame:
    """A scorer that needs no model: the probability is a function of the transaction id."""
    return events.withColumn("ml_probability", probability_of(number_of()))


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer with events: usual country, the next country, spend average, event count.

    The average is an exact decimal sum over a count, so it is the same for any partitioning.
    Spend is added up before the shuffle, whatever share of the events a user has.
    """
    nations = input_table(spark, sf_dir, "nation")
    usual = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("usual_country"))
    following = nations.select(F.col("n_nationkey").alias("next_key"), F.col("n_name").alias("next_country"))
    spend = (
        input_table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.sum(F.col("value").cast(T.DecimalType(12, 2))).cast("double").alias("spent"),
            F.count(F.lit(1)).alias("key_rows"),
        )
    )
    customers = input_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    return (
        spend.join(customers, "user_id")
        .withColumn("next_key", (F.col("c_nationkey") + 1) % 25)
        .join(usual, "c_nationkey")
        .join(following, "next_key")
        .select(
            "user_id",
            "usual_country",
            "next_country",
            (F.col("spent") / F.col("key_rows")).alias("user_avg_amount"),
            "key_rows",
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as user profiles; without events the average is null. No job rates users, so the risk is."""
    nations = input_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("usual_country")
    )
    averages = user_profiles(spark, sf_dir).select(
        F.concat(F.lit("U"), "user_id").alias("user_id"), F.col("user_avg_amount").alias("avg_amount")
    )
    customers = input_table(spark, sf_dir, "customer").join(nations, "c_nationkey")
    named = customers.select(F.concat(F.lit("U"), "c_custkey").alias("user_id"), "usual_country")
    joined = named.join(averages, "user_id", "left").withColumn("risk_level", F.lit(None).cast("string"))
    return joined.select(*USERS.names)


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per event row, with a supplied probability, not yet scored."""
    profiles = durable(user_profiles(spark, sf_dir))  # read several times below, a row a user
    joined = lookup(
        spread(input_table(spark, sf_dir, "events")),
        profiles.drop("key_rows"),
        "user_id",
        key_counts=profiles.select("user_id", "key_rows"),
        spread_by="event_id",
    )
    n = F.col("event_id")
    amount = F.when(n % 13 == 0, F.col("value") * 60.0).otherwise(F.col("value"))
    return joined.select(
        n.alias("n"),
        F.concat(F.lit("TX-"), n).alias("transaction_id"),
        F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
        amount.alias("amount"),
        F.lit("EUR").alias("currency"),
        F.when(n % 11 == 0, F.col("next_country")).otherwise(F.col("usual_country")).alias("country"),
        "usual_country",
        _cycle(n, CATEGORIES).alias("merchant_category"),
        _cycle(n, PAYMENT_METHODS).alias("payment_method"),
        F.concat(F.lit("D-"), 100 + (n * 37) % 900).alias("device_id"),
        F.concat(F.lit("192.168.1."), 1 + n % 255).alias("ip_address"),
        F.col("ts").alias("event_time"),
        "user_avg_amount",
        (amount / F.greatest(F.col("user_avg_amount"), F.lit(SMALLEST_AVERAGE))).alias("amount_vs_avg_user"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("actual_label"),
        probability_of(n).alias("ml_probability"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with all scores; the processing time is the event's own, so it is stable."""
    return with_decision(with_rule_scores(payment_events(spark, sf_dir)), F.col("event_time"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_rows(scored_events(spark, sf_dir))


def number_of(transaction_id: str = "transaction_id") -> Column:
    """The event number that an id was made from."""
    return F.substr(F.col(transaction_id), F.lit(4)).try_cast("bigint")


def damaged(stored: DataFrame) -> DataFrame:
    """Stored transactions with planted defects, for the quality checks; some rows come twice."""
    n = F.col("n")

    def every(step: int) -> Column:
        return n % step == 0

    def unless(condition: Column, name: str) -> Column:
        return F.when(condition, None).otherwise(F.col(name))

    rows = stored.withColumn("n", number_of())
    damage = {
        "transaction_id": unless(every(211), "transaction_id"),
        "user_id": unless(every(97), "user_id"),
        "amount": F.when(every(89), F.lit(-1)).when(every(179), None).otherwise(F.col("amount")).cast("decimal(12,2)"),
        "transaction_status": F.when(every(83), "UNKNOWN").otherwise(F.col("transaction_status")),
        "risk_score": F.when(every(79), None).when(every(73), 101).otherwise(F.col("risk_score")),
        "transaction_timestamp": unless(every(71), "transaction_timestamp"),
        "ml_probability": F.when(every(67), None)
        .when(every(61), F.lit(1.5).cast(PROBABILITY))
        .otherwise(F.col("ml_probability")),
        "behavior_score": F.when(every(59), None).when(every(53), 101).otherwise(F.col("behavior_score")),
        "final_score": F.when(every(47), None).when(every(43), 101).otherwise(F.col("final_score")),
        "detection_method": unless(every(41), "detection_method"),
        "actual_label": F.when(every(37), 2).when(n % 10 == 1, None).otherwise(F.col("actual_label")),
    }
    copies = F.explode(F.when(every(101), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    columns = [damage.get(name, F.col(name)).alias(name) for name in TRANSACTIONS.names]
    return rows.select(*columns, copies.alias("_copy")).drop("_copy")


def lossy_alerts(stored: DataFrame) -> DataFrame:
    """Alerts of stored transactions with planted loss, plus orphans of ids that do not exist."""
    n = number_of()
    written = F.when(is_alertable() & (n % 10 != 0), F.col("transaction_id"))
    orphan = F.when(n % 500 == 0, F.concat(F.lit("TX-X"), n))
    ids = F.explode(F.array_compact(F.array(written, orphan)))
    is_orphan = F.col("_alerted") != F.col("transaction_id")
    alerted = stored.withColumn("_alerted", ids).withColumns(
        {
            "transaction_status": F.when(is_orphan, FRAUD).otherwise(F.col("transaction_status")),
            "transaction_id": F.col("_alerted"),
        }
    )
    return alert_rows(alerted, fixed_point=True)


def json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as JSON text in ``value``, one message per event, with planted faults.

    Every fifth message has only the short form's fields. Nine residues of fifty are damaged
    or altered, as a live topic would have them.
    """
    n = F.col("n")
    residue = n % 50
    events = events_with_signals(spark, sf_dir)

    def unless(condition: Column, name: str) -> Column:
        return F.when(~condition, F.col(name)).alias(name)

    short = n % 5 == 0
    fields = F.struct(
        unless(residue == 2, "transaction_id"),
        unless(residue == 3, "user_id"),
        unless(residue == 4, "amount"),
        "currency",
        unless(residue == 8, "country"),
        "usual_country",
        "merchant_category",
        "payment_method",
        "device_id",
        "ip_address",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        *[unless(short, c) for c in ("user_avg_amount", "amount_vs_avg_user")],
        F.when(residue == 11, F.lit(1e12)).when(~short, F.col("actual_label")).alias("actual_label"),
        *[unless(short, c) for c in ("Time", *SIGNAL_FIELDS)],
        F.when(residue == 7, "x").alias("unknown_field"),
    )
    body = F.col("body")
    value = (
        F.when(residue == 1, "{bad")
        .when(residue == 4, F.concat(F.lit('{"amount":"3.5",'), F.substr(body, F.lit(2))))
        .when(residue == 6, F.regexp_replace(body, r'"timestamp":"[^"]*"', '"timestamp":"2024-01-01T00:00:00"'))
        .when(residue == 9, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
    )
    return events.select("n", F.to_json(fields).alias("body")).select(value.alias("value"))


def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled training table from the embedding vectors, with a planted signal in V1, V2."""
    vectors = input_table(spark, sf_dir, "embeddings")
    fraud = F.col("vec_id") % 10 == 0
    shift = F.when(fraud, 0.3).otherwise(0.0)

    def signal(i: int) -> Column:
        value = F.col("embedding")[i - 1].cast("double")
        return value + shift if i <= 2 else value

    return vectors.select(
        F.col("vec_id").cast("double").alias("Time"),
        *[signal(i).alias(name) for i, name in enumerate(SIGNAL_FIELDS, start=1)],
        (F.abs(F.col("embedding")[28].cast("double")) * 1000).alias("Amount"),
        fraud.cast("int").alias(LABEL),
    ).select(*LABELLED.names)


def events_with_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments, with model inputs where a labelled row of the same number exists."""
    signals = labelled_rows(spark, sf_dir).select(
        F.col("Time").cast("bigint").alias("n"), "Time", *SIGNAL_FIELDS
    )
    payments = payment_events(spark, sf_dir).drop("ml_probability")
    return lookup(payments, signals, "n", how="left")
