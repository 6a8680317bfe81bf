"""Blend of rules, model and behavior into one score and a three-way status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.schemas import FRAUD, HYBRID_METHOD, NORMAL, SUSPICIOUS

# --- fixed values: weights and cut-offs of the decision contract ---
RULE_WEIGHT, MODEL_WEIGHT, BEHAVIOR_WEIGHT = 0.35, 0.45, 0.20
FRAUD_SCORE = 60
FRAUD_RULES, FRAUD_PROBABILITY = 50, 0.10
SUSPICIOUS_SCORE = 35
SUSPICIOUS_PROBABILITY = 0.08
SUSPICIOUS_RULES = 40
# --- end of fixed values ---


def ml_score() -> Column:
    return F.col("ml_probability") * 100


def final_score() -> Column:
    """Weighted blend in double arithmetic, summed left to right, rounded half up.

    Decimal weights or another order would move scores that sit on a rounding edge.
    """
    blend = (
        F.col("rule_score") * RULE_WEIGHT
        + F.col("ml_score") * MODEL_WEIGHT
        + F.col("behavior_score") * BEHAVIOR_WEIGHT
    )
    return F.round(blend).cast("int")


def transaction_status() -> Column:
    score, rules, probability = F.col("final_score"), F.col("rule_score"), F.col("ml_probability")
    fraud = (score >= FRAUD_SCORE) | ((rules >= FRAUD_RULES) & (probability >= FRAUD_PROBABILITY))
    suspicious = (
        (score >= SUSPICIOUS_SCORE) | (probability >= SUSPICIOUS_PROBABILITY) | (rules >= SUSPICIOUS_RULES)
    )
    return F.when(fraud, FRAUD).when(suspicious, SUSPICIOUS).otherwise(NORMAL)


def with_decision(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Scores and status for events that carry rule scores and ``ml_probability``.

    The status uses the unrounded probability. ``processed_at`` defaults to the time of the
    running query, which is one value for all its rows.
    """
    if processed_at is None:
        processed_at = F.localtimestamp()
    return (
        events.withColumn("ml_score", ml_score())
        .withColumn("final_score", final_score())
        .withColumns(
            {
                "transaction_status": transaction_status(),
                "risk_score": F.col("final_score"),
                "detection_method": F.lit(HYBRID_METHOD),
                "processed_at": processed_at,
            }
        )
    )
