"""Decisions against known labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.measures import ROWS, RowMeasures
from riskstream.functions.predicates import is_alertable, is_labelled
from riskstream.schemas import ALL_STATUSES, NORMAL

# --- fixed values: columns of the top listing ---
PREDICTION_DETAILS = (
    "transaction_id",
    "user_id",
    "amount",
    "country",
    "usual_country",
    "merchant_category",
    "payment_method",
    "ml_probability",
    "behavior_score",
    "final_score",
    "risk_score",
    "transaction_status",
    "actual_label",
    "detection_method",
    "transaction_timestamp",
    "processed_at",
)
# --- end of fixed values ---


def confusion(transactions: DataFrame, m: RowMeasures = ROWS) -> DataFrame:
    """One row of counts; flagged means suspicious or fraud. All zero without labelled rows."""
    flagged, passed = is_alertable(), F.col("transaction_status") == NORMAL
    cells = {
        "true_positives": (1, flagged),
        "false_positives": (0, flagged),
        "true_negatives": (0, passed),
        "false_negatives": (1, passed),
    }
    return transactions.filter(is_labelled()).agg(
        *[m.count_where((F.col("actual_label") == label) & outcome).alias(name) for name, (label, outcome) in cells.items()]
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_metrics(transactions: DataFrame, evaluated_at: Column | None = None, m: RowMeasures = ROWS) -> DataFrame:
    """Counts with precision, recall, F1 and accuracy to four places; empty ratios are 0.0."""
    tp, fp, tn, fn = (
        F.col(c) for c in ("true_positives", "false_positives", "true_negatives", "false_negatives")
    )
    ratios = confusion(transactions, m).withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "accuracy": _ratio(tp + tn, tp + fp + tn + fn),
        }
    )
    precision, recall = F.col("precision"), F.col("recall")
    metrics = ratios.withColumn("f1_score", _ratio(2 * precision * recall, precision + recall))
    if evaluated_at is None:
        evaluated_at = F.date_trunc("second", F.localtimestamp()).cast("timestamp_ntz")
    return metrics.select(
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
        *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1_score", "accuracy")],
        evaluated_at.alias("evaluated_at"),
    )


def label_status_breakdown(transactions: DataFrame, m: RowMeasures = ROWS) -> DataFrame:
    return (
        transactions.filter(is_labelled())
        .groupBy("actual_label", "transaction_status")
        .agg(
            m.rows("total"),
            m.mean("ml_probability"),
            m.mean("behavior_score"),
            m.mean("final_score"),
            m.peak("final_score"),
        )
        .orderBy("actual_label", "transaction_status")
    )


def label_status_matrix(transactions: DataFrame, wide: bool = False, m: RowMeasures = ROWS) -> DataFrame:
    """Counts per label and status; ``wide`` gives one column per status."""
    labelled = transactions.filter(is_labelled())
    if wide:
        pivoted = labelled.groupBy("actual_label").pivot("transaction_status", list(ALL_STATUSES))
        return pivoted.agg(m.rows("total")).na.fill(0).orderBy("actual_label")
    counted = labelled.groupBy("actual_label", "transaction_status").agg(m.rows("total"))
    return counted.orderBy("actual_label", "transaction_status")


def label_profile(transactions: DataFrame, m: RowMeasures = ROWS) -> DataFrame:
    return (
        transactions.filter(is_labelled())
        .groupBy("actual_label")
        .agg(m.rows("total"), m.mean("ml_probability"), m.mean("final_score"), m.peak("final_score"))
        .orderBy("actual_label")
    )


def top_predictions(transactions: DataFrame, top: int = 100) -> DataFrame:
    labelled = transactions.filter(is_labelled()).select(*PREDICTION_DETAILS)
    return labelled.orderBy(F.col("final_score").desc(), "transaction_id").limit(top)
