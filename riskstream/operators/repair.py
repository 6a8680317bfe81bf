"""Find and write alerts that a crash between table writes left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.projections import repair_alert_rows
from riskstream.operators.reconcile import transactions_without_alert
from riskstream.session import durable

# --- fixed values: columns of the repair listing ---
LISTED = (
    "transaction_id",
    "user_id",
    "amount",
    "currency",
    "country",
    "usual_country",
    "merchant_category",
    "payment_method",
    "risk_score",
    "transaction_status",
    "transaction_timestamp",
    "processed_at",
)
# --- end of fixed values ---


def newest_first(listing: DataFrame) -> DataFrame:
    return listing.orderBy(F.col("processed_at").desc(), "transaction_id")


def missing_alerts(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alertable transactions without an alert, newest first."""
    return newest_first(transactions_without_alert(transactions, alerts).select(*LISTED))


def repair_report(missing: DataFrame, repaired_at: Column) -> DataFrame:
    """The repaired rows with their total, or a single row saying that none were missing."""
    total = missing.count()
    if total == 0:
        return missing.sparkSession.range(1).select(
            F.lit("NO_MISSING_ALERTS").alias("status"),
            F.lit(0).cast("bigint").alias("repaired_count"),
            repaired_at.alias("checked_at"),
        )
    return missing.withColumns(
        {
            "repair_status": F.lit("REPAIRED"),
            "repaired_at": repaired_at,
            "repaired_count_total": F.lit(total).cast("bigint"),
        }
    )


def repair(store, run_id: str, repaired_at: Column | None = None) -> DataFrame:
    """Append the missing alerts in one job and return the repair report.

    The missing rows are written to the shared folder first, and both the alerts and the
    report come from that copy. Were the anti-join evaluated again after the append, as
    happens to a cached frame when an executor is lost, it would find nothing.
    """
    if repaired_at is None:
        repaired_at = F.date_trunc("second", F.localtimestamp()).cast("timestamp_ntz")
    run = f"repair-{run_id}"
    alerts = store.read("fraud_alerts", other_than=run)
    missing = durable(transactions_without_alert(store.read("transactions"), alerts).select(*LISTED))
    store.write_run(run, {"fraud_alerts": repair_alert_rows(missing, repaired_at)})
    return repair_report(newest_first(missing), repaired_at)
