"""Rows of the result tables, from scored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.predicates import is_alertable
from riskstream.functions.rules import RULES
from riskstream.schemas import FRAUD_ALERTS, MONEY, PROBABILITY, RISK_SCORES, TRANSACTIONS

# --- fixed values: alert constants ---
SCORING_ALERT = "HYBRID_FRAUD_DETECTION"
REPAIR_ALERT = "REAL_TIME_FRAUD_DETECTION"
OPEN = "OPEN"
# --- end of fixed values ---


def row_key(*parts: Column) -> Column:
    """Deterministic surrogate key.

    A 128-bit digest: unlike a running number it needs no coordination and survives a
    replay, and unlike a 64-bit hash it stays free of collisions at 10**11 rows.
    """
    return F.md5(F.concat_ws("|", *parts))


def transaction_rows(scored: DataFrame) -> DataFrame:
    stored = {
        "amount": F.col("amount").cast(MONEY),
        "ml_probability": F.col("ml_probability").cast(PROBABILITY),
        # a label beyond the integers, or NaN, is unknown; under ANSI rules a plain cast would stop the stream
        "actual_label": F.when(~F.isnan("actual_label"), F.col("actual_label").try_cast("int")),
        "transaction_timestamp": F.col("event_time"),
    }
    return scored.select(*[stored.get(name, F.col(name)).alias(name) for name in TRANSACTIONS.names])


def risk_score_rows(scored: DataFrame) -> DataFrame:
    stored = {
        "id": row_key(F.col("transaction_id")),
        "decision": F.col("transaction_status"),
        "created_at": F.col("processed_at"),
        **{name: F.col(name).cast("int") for name in RULES},
    }
    return scored.select(*[stored.get(name, F.col(name)).alias(name) for name in RISK_SCORES.names])


def _sentence(*parts: str | Column) -> Column:
    """Parts joined as text; null as soon as one part is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _alert_rows(alerting: DataFrame, alert_type: str, message: Column, created_at: Column) -> DataFrame:
    stored = {
        "alert_id": row_key(F.col("transaction_id"), F.lit(alert_type)),
        "alert_type": F.lit(alert_type),
        "message": message,
        "status": F.lit(OPEN),
        "created_at": created_at,
    }
    return alerting.select(*[stored.get(name, F.col(name)).alias(name) for name in FRAUD_ALERTS.names])


def alert_rows(scored: DataFrame, fixed_point: bool = False) -> DataFrame:
    """Alerts for the suspicious and fraudulent events.

    The message shows the probability as Spark prints a double, or with four decimals when
    ``fixed_point`` is set.
    """
    shown = F.col("ml_probability").cast(PROBABILITY) if fixed_point else F.col("ml_probability")
    message = _sentence(
        "Transaction ", F.col("transaction_id"), " detected as ", F.col("transaction_status"),
        " | final_score=", F.col("final_score"), " | ml_probability=", shown,
    )
    return _alert_rows(scored.filter(is_alertable()), SCORING_ALERT, message, F.col("processed_at"))


def repair_alert_rows(missing: DataFrame, created_at: Column) -> DataFrame:
    """Alerts for stored transactions that should have had one."""
    message = _sentence(
        "Transaction ", F.col("transaction_id"), " detected as ", F.col("transaction_status"),
        " with risk score ", F.col("risk_score"),
    )
    return _alert_rows(missing, REPAIR_ALERT, message, created_at)
