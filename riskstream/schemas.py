"""Declared schemas of events and result tables.

Every reader uses these instead of inference, so a scan never samples its input
and a bad file cannot change a column's type.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# --- fixed values: field names, order and storage types of the public contract ---
SIGNAL_FIELDS = tuple(f"V{i}" for i in range(1, 29))
MODEL_FEATURES = ("Time", *SIGNAL_FIELDS, "Amount")
LABEL = "Class"

MONEY = DecimalType(12, 2)
PROBABILITY = DecimalType(6, 4)
MONEY_TOTAL = DecimalType(22, 2)
# Amounts at or beyond this bound do not fit MONEY once rounded to cents.
MONEY_BOUND = 9_999_999_999.995

NORMAL, SUSPICIOUS, FRAUD = "NORMAL", "SUSPICIOUS", "FRAUD"
ALL_STATUSES = (NORMAL, SUSPICIOUS, FRAUD)
ALERTABLE = (SUSPICIOUS, FRAUD)
HYBRID_METHOD = "HYBRID_RULES_ML_BEHAVIOR"

EVENT = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("country", StringType()),
        StructField("usual_country", StringType()),
        StructField("merchant_category", StringType()),
        StructField("payment_method", StringType()),
        StructField("device_id", StringType()),
        StructField("ip_address", StringType()),
        StructField("timestamp", StringType()),
        StructField("user_avg_amount", DoubleType()),
        StructField("amount_vs_avg_user", DoubleType()),
        StructField("actual_label", DoubleType()),
        StructField("Time", DoubleType()),
        *[StructField(name, DoubleType()) for name in SIGNAL_FIELDS],
    ]
)

TRANSACTIONS = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("amount", MONEY),
        StructField("currency", StringType()),
        StructField("country", StringType()),
        StructField("usual_country", StringType()),
        StructField("merchant_category", StringType()),
        StructField("payment_method", StringType()),
        StructField("device_id", StringType()),
        StructField("ip_address", StringType()),
        StructField("transaction_timestamp", TimestampNTZType()),
        StructField("transaction_status", StringType()),
        StructField("risk_score", IntegerType()),
        StructField("ml_probability", PROBABILITY),
        StructField("behavior_score", IntegerType()),
        StructField("final_score", IntegerType()),
        StructField("detection_method", StringType()),
        StructField("actual_label", IntegerType()),
        StructField("processed_at", TimestampNTZType()),
    ]
)

RISK_SCORES = StructType(
    [
        StructField("id", StringType()),
        StructField("transaction_id", StringType()),
        StructField("amount_score", IntegerType()),
        StructField("country_score", IntegerType()),
        StructField("merchant_score", IntegerType()),
        StructField("time_score", IntegerType()),
        StructField("device_score", IntegerType()),
        StructField("frequency_score", IntegerType()),
        StructField("final_score", IntegerType()),
        StructField("decision", StringType()),
        StructField("created_at", TimestampNTZType()),
    ]
)

FRAUD_ALERTS = StructType(
    [
        StructField("alert_id", StringType()),
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("risk_score", IntegerType()),
        StructField("alert_type", StringType()),
        StructField("message", StringType()),
        StructField("status", StringType()),
        StructField("created_at", TimestampNTZType()),
    ]
)

USERS = StructType(
    [
        StructField("user_id", StringType()),
        StructField("usual_country", StringType()),
        StructField("avg_amount", DoubleType()),
        StructField("risk_level", StringType()),
    ]
)

LABELLED = StructType(
    [
        *[StructField(name, DoubleType()) for name in MODEL_FEATURES],
        StructField(LABEL, IntegerType()),
    ]
)
# --- end of fixed values ---

REJECTED = StructType(
    [
        StructField("body", StringType()),
        StructField("reject_reason", StringType()),
        StructField("rejected_at", TimestampNTZType()),
    ]
)

#: Row checks counted over a run while it was written, and the newest time in it.
OBSERVED_CHECKS = (
    "missing_transaction_id",
    "missing_user_id",
    "invalid_amount",
    "invalid_transaction_status",
    "missing_risk_score",
    "invalid_risk_score",
    "missing_transaction_timestamp",
    "missing_ml_probability",
    "invalid_ml_probability",
    "missing_behavior_score",
    "invalid_behavior_score",
    "missing_final_score",
    "invalid_final_score",
    "missing_detection_method",
    "invalid_actual_label",
)
BATCH_QUALITY = StructType(
    [
        StructField("row_count", LongType()),
        StructField("observed_at", TimestampNTZType()),
        *[StructField(name, LongType()) for name in OBSERVED_CHECKS],
    ]
)

DAILY_REPORTS = StructType(
    [
        StructField("report_date", DateType()),
        StructField("total_transactions", LongType()),
        *[StructField(f"total_{status.lower()}", LongType()) for status in ALL_STATUSES],
        StructField("total_fraud_amount", MONEY_TOTAL),
    ]
)

SPEND_PROFILES = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("event_time", TimestampNTZType()),
        StructField("user_avg_amount", DoubleType()),
        StructField("amount_vs_avg_user", DoubleType()),
    ]
)

#: What users spent in one run, in cents, and in how many rows.
USER_SPEND = StructType(
    [
        StructField("user_id", StringType()),
        StructField("spent", DecimalType(20, 0)),
        StructField("row_count", LongType()),
        StructField("until", TimestampNTZType()),
    ]
)

FRAUD_MINUTES = StructType([StructField("minute", TimestampNTZType()), StructField("fraud_count", LongType())])
