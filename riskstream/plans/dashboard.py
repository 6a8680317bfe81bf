"""Queries behind the monitoring page."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.measures import ROWS, RowMeasures
from riskstream.functions.predicates import is_alertable, is_fraud, status_in
from riskstream.plans.daily import ALERT_DETAILS, summary_measures
from riskstream.schemas import FRAUD_ALERTS

Statuses = Iterable[str] | None
BINS = 20


def kpi_block(transactions: DataFrame, statuses: Statuses = None, m: RowMeasures = ROWS) -> DataFrame:
    return transactions.filter(status_in(statuses)).agg(*summary_measures(m))


def status_distribution(transactions: DataFrame, statuses: Statuses = None, m: RowMeasures = ROWS) -> DataFrame:
    counted = transactions.filter(status_in(statuses)).groupBy("transaction_status").agg(m.rows("count"))
    return counted.orderBy(F.col("count").desc(), "transaction_status")


def top_countries(transactions: DataFrame, top: int = 10, m: RowMeasures = ROWS) -> DataFrame:
    counted = transactions.filter(is_alertable()).groupBy("country").agg(m.rows("total_alerts"))
    return counted.orderBy(F.col("total_alerts").desc(), "country").limit(top)


def binned(value: Column) -> Column:
    """Bin number of a value measured in bin widths; past either end the end bin."""
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(value).cast("int")))


def probability_bin() -> Column:
    return binned(F.col("ml_probability") * BINS)


def _histogram(transactions: DataFrame, bin_no: Column, width: float, statuses: Statuses, m: RowMeasures) -> DataFrame:
    """Rows per bin for the rows that have one."""
    counted = transactions.filter(status_in(statuses)).groupBy(bin_no.alias("bin")).agg(m.rows("count"))
    known = counted.filter(F.col("bin").isNotNull())
    return known.select("bin", (F.col("bin") * F.lit(width)).alias("bin_start"), "count").orderBy("bin")


def final_score_histogram(transactions: DataFrame, statuses: Statuses = None, m: RowMeasures = ROWS) -> DataFrame:
    """Twenty bins over 0..100."""
    score = F.col("final_score")
    return _histogram(transactions, F.when(score.isNotNull(), binned(score / 5)), 5.0, statuses, m)


def probability_histogram(transactions: DataFrame, statuses: Statuses = None, m: RowMeasures = ROWS) -> DataFrame:
    """Twenty bins over 0..1, on the stored four-decimal probability."""
    known = F.col("ml_probability").isNotNull()
    bin_no = F.when(known, probability_bin()) if m is ROWS else F.col("probability_bin")
    return _histogram(transactions, bin_no, 0.05, statuses, m)


def behavior_distribution(transactions: DataFrame, statuses: Statuses = None, m: RowMeasures = ROWS) -> DataFrame:
    known = transactions.filter(F.col("behavior_score").isNotNull() & status_in(statuses))
    return known.groupBy("behavior_score").agg(m.rows("count")).orderBy("behavior_score")


def method_distribution(transactions: DataFrame, statuses: Statuses = None, m: RowMeasures = ROWS) -> DataFrame:
    known = transactions.filter(F.col("detection_method").isNotNull() & status_in(statuses))
    counted = known.groupBy("detection_method").agg(m.rows("count"))
    return counted.orderBy(F.col("count").desc(), "detection_method")


def frauds_per_minute(transactions: DataFrame, time: str = "processed_at") -> DataFrame:
    minute = F.date_trunc("minute", F.col(time)).cast("timestamp_ntz").alias("minute")
    return transactions.filter(is_fraud()).groupBy(minute).agg(ROWS.rows("fraud_count")).orderBy("minute")


def latest_transactions(transactions: DataFrame, statuses: Statuses = None, top: int = 30) -> DataFrame:
    chosen = transactions.filter(status_in(statuses)).select(*ALERT_DETAILS)
    return chosen.orderBy(F.col("processed_at").desc(), "transaction_id").limit(top)


def latest_alerts(alerts: DataFrame, top: int = 30) -> DataFrame:
    listed = alerts.select(*FRAUD_ALERTS.names)
    return listed.orderBy(F.col("created_at").desc(), "transaction_id", "alert_id").limit(top)
