"""The eighteen data-quality checks, their report and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskstream.functions.predicates import status_in
from riskstream.operators.reconcile import duplicated_ids, key_checks
from riskstream.schemas import BATCH_QUALITY, HYBRID_METHOD, OBSERVED_CHECKS


class QualityGateError(ValueError):
    """At least one check failed."""


def _missing(name: str) -> Column:
    return F.col(name).isNull()


def _missing_when_hybrid(name: str) -> Column:
    return (F.col("detection_method") == HYBRID_METHOD) & _missing(name)


def _outside(name: str, top: int) -> Column:
    """Present and not in [0, top]."""
    return ~F.col(name).between(0, top)


# Check name -> predicate of a faulty row. Predicates may be null, which is not a fault.
ROW_CHECKS = {
    "missing_transaction_id": lambda: _missing("transaction_id"),
    "missing_user_id": lambda: _missing("user_id"),
    "invalid_amount": lambda: _missing("amount") | (F.col("amount") < 0),
    "invalid_transaction_status": lambda: _missing("transaction_status") | ~status_in(),
    "missing_risk_score": lambda: _missing("risk_score"),
    "invalid_risk_score": lambda: _outside("risk_score", 100),
    "missing_transaction_timestamp": lambda: _missing("transaction_timestamp"),
    "missing_ml_probability": lambda: _missing_when_hybrid("ml_probability"),
    "invalid_ml_probability": lambda: _outside("ml_probability", 1),
    "missing_behavior_score": lambda: _missing_when_hybrid("behavior_score"),
    "invalid_behavior_score": lambda: _outside("behavior_score", 100),
    "missing_final_score": lambda: _missing_when_hybrid("final_score"),
    "invalid_final_score": lambda: _outside("final_score", 100),
    "missing_detection_method": lambda: _missing("detection_method"),
    "invalid_actual_label": lambda: ~F.col("actual_label").isin(0, 1),
}
# --- fixed values: the checks in report order ---
CHECKS = (
    "missing_transaction_id",
    "missing_user_id",
    "invalid_amount",
    "invalid_transaction_status",
    "missing_risk_score",
    "invalid_risk_score",
    "missing_transaction_timestamp",
    "duplicated_transaction_id",
    "missing_ml_probability",
    "invalid_ml_probability",
    "missing_behavior_score",
    "invalid_behavior_score",
    "missing_final_score",
    "invalid_final_score",
    "missing_detection_method",
    "invalid_actual_label",
    "fraud_alert_without_transaction",
    "fraud_transaction_without_alert",
)
# --- end of fixed values ---


def row_checks(transactions: DataFrame) -> DataFrame:
    """All single-row checks in one pass, one row of counts, no row shuffled."""
    return transactions.agg(*[F.count_if(faulty()).alias(name) for name, faulty in ROW_CHECKS.items()])


def write_checked(store, run_id: str, tables: dict[str, DataFrame], one_day: bool = False) -> None:
    """Write a run whose row checks are counted in the pass that writes its transactions.

    The counts are stored as one row of the run, which a replay replaces with the run; no table is read for them.
    """
    seen = Observation()
    counts = [F.count_if(ROW_CHECKS[name]()).alias(name) for name in OBSERVED_CHECKS]
    whole = [F.count(F.lit(1)).alias("row_count"), F.max("processed_at").alias("observed_at")]
    observed = tables["transactions"].observe(seen, *whole, *counts)
    store.write_run(run_id, {**tables, "transactions": observed}, one_day)
    metrics = seen.get
    row = tuple(metrics.get(name, None if name == "observed_at" else 0) for name in BATCH_QUALITY.names)
    store.write_run(run_id, {"batch_quality": store.spark.createDataFrame([row], BATCH_QUALITY)}, one_day=True)


def observed_checks(batch_quality: DataFrame) -> DataFrame:
    """``check_name, issue_count`` of the row checks over all stored runs, from the counts of each."""
    return _long(batch_quality.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in OBSERVED_CHECKS]))


def _long(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "check_name", "issue_count")


def check_count(name: str, transactions: DataFrame, alerts: DataFrame | None = None) -> DataFrame:
    """A single check's ``issue_count``."""
    if name in ROW_CHECKS:
        return transactions.agg(F.count_if(ROW_CHECKS[name]()).alias("issue_count"))
    if name == "duplicated_transaction_id":
        return duplicated_ids(transactions).agg(F.count(F.lit(1)).alias("issue_count"))
    return key_checks(transactions, alerts).select(F.col(name).alias("issue_count"))


def quality_report(transactions: DataFrame, alerts: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """``check_name, status, issue_count, checked_at``, one row per check.

    Two scans of the transactions in all: a full-width pass without a shuffle, and a pass over
    two columns grouped by id.
    """
    if checked_at is None:
        checked_at = F.date_trunc("second", F.localtimestamp()).cast("timestamp_ntz")
    counts = _long(row_checks(transactions)).unionByName(_long(key_checks(transactions, alerts)))
    position = F.array_position(F.array(*[F.lit(c) for c in CHECKS]), F.col("check_name"))
    return counts.orderBy(position).select(
        "check_name",
        F.when(F.col("issue_count") == 0, "PASSED").otherwise("FAILED").alias("status"),
        "issue_count",
        checked_at.alias("checked_at"),
    )


def enforce(report: DataFrame) -> None:
    """Raise when the report (at most eighteen rows) has a failed check."""
    failed = report.filter(F.col("status") == "FAILED").select("check_name", "issue_count").collect()
    if failed:
        listing = ", ".join(f"{r.check_name}={r.issue_count}" for r in failed)
        raise QualityGateError(f"data quality checks failed: {listing}")
