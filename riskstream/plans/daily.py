"""The daily report: summary, status and country breakdowns, alert listing, daily rollup."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.functions.measures import ROWS, RowMeasures
from riskstream.functions.predicates import is_alertable
from riskstream.schemas import ALL_STATUSES, DAILY_REPORTS, FRAUD, PROBABILITY, SUSPICIOUS
from riskstream.session import durable

DAY = timedelta(days=1)

# --- fixed values: columns of the alert listing ---
ALERT_DETAILS = (
    "transaction_id",
    "user_id",
    "amount",
    "currency",
    "country",
    "usual_country",
    "merchant_category",
    "payment_method",
    "risk_score",
    "ml_probability",
    "behavior_score",
    "final_score",
    "transaction_status",
    "actual_label",
    "detection_method",
    "transaction_timestamp",
    "processed_at",
)
# --- end of fixed values ---


def summary_measures(m: RowMeasures = ROWS) -> list:
    return [
        m.rows("total_transactions"),
        *[m.rows_with_status(status) for status in ALL_STATUSES],
        m.fraud_money("total_fraud_amount"),
        m.mean("ml_probability"),
        m.mean("behavior_score"),
        m.mean("final_score"),
    ]


def daily_summary(transactions: DataFrame, m: RowMeasures = ROWS) -> DataFrame:
    return transactions.agg(*summary_measures(m), m.peak("ml_probability", PROBABILITY), m.peak("final_score"))


def status_breakdown(transactions: DataFrame, m: RowMeasures = ROWS) -> DataFrame:
    return (
        transactions.groupBy("transaction_status")
        .agg(m.rows("total"), m.mean("ml_probability"), m.mean("final_score"), m.peak("final_score"))
        .orderBy("transaction_status")
    )


def top_alert_countries(transactions: DataFrame, top: int = 20, m: RowMeasures = ROWS) -> DataFrame:
    return (
        transactions.filter(is_alertable())
        .groupBy("country")
        .agg(
            m.rows("total_alerts"),
            m.rows_with_status(FRAUD),
            m.rows_with_status(SUSPICIOUS),
            m.fraud_money("fraud_amount"),
        )
        .orderBy(F.col("total_alerts").desc(), "country")
        .limit(top)
    )


def alert_details(transactions: DataFrame) -> DataFrame:
    """Every alertable transaction, newest first: a range-partitioned sort, no single-task step."""
    alerting = transactions.filter(is_alertable()).select(*ALERT_DETAILS)
    return alerting.orderBy(F.col("processed_at").desc(), "transaction_id")


def refresh_reports(store, new: DataFrame) -> None:
    """Recompute the stored daily reports of the dates that ``new`` rows fall on, from all rows of those dates.

    Reports of other dates are neither read nor written.
    """
    dated = F.to_date("transaction_timestamp")
    dates = durable(new.select(dated.alias("report_date")).filter("report_date IS NOT NULL").distinct())
    span = dates.agg(F.min("report_date").alias("first"), F.max("report_date").alias("last")).first()
    if span.first is None:
        return
    # the span reaches the scan as a filter; the dates are a row a day
    near = F.col("transaction_timestamp").between(F.lit(span.first).cast("timestamp_ntz"), F.lit(span.last + DAY).cast("timestamp_ntz"))
    touched = store.read("transactions").filter(near).withColumn("report_date", dated)
    touched = touched.join(F.broadcast(dates), "report_date", "left_semi")
    store.upsert("daily_reports", daily_rollup(touched).select(*DAILY_REPORTS.names), ["report_date"])


def daily_rollup(transactions: DataFrame) -> DataFrame:
    """Totals per event date, for a table of daily reports."""
    return (
        transactions.groupBy(F.to_date("transaction_timestamp").alias("report_date"))
        .agg(
            ROWS.rows("total_transactions"),
            *[ROWS.rows_with_status(status) for status in ALL_STATUSES],
            ROWS.fraud_money("total_fraud_amount"),
        )
        .orderBy("report_date")
    )
