"""One scan for all breakdowns of the monitoring page and the reports.

Each breakdown alone scans the transactions. Refreshed together they can share one pass: the
cube has a row per combination of the few-valued columns, so its size follows the number of
combinations and not the number of transactions, and every breakdown is a small aggregation
of it with the very same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.measures import CUBE
from riskstream.plans import daily, dashboard, evaluation
from riskstream.session import durable

DIMENSIONS = (
    "transaction_status",
    "country",
    "behavior_score",
    "final_score",
    "detection_method",
    "actual_label",
)


def activity_cube(transactions: DataFrame) -> DataFrame:
    probability_bin = F.when(F.col("ml_probability").isNotNull(), dashboard.probability_bin())
    return transactions.groupBy(*DIMENSIONS, probability_bin.alias("probability_bin")).agg(
        F.count(F.lit(1)).alias("cell_rows"),
        F.sum("amount").alias("amount_sum"),
        F.sum("ml_probability").alias("probability_sum"),
        F.count("ml_probability").alias("probability_known"),
        F.max("ml_probability").alias("probability_max"),
    )


PANELS = {
    "daily_summary": daily.daily_summary,
    "status_breakdown": daily.status_breakdown,
    "top_alert_countries": daily.top_alert_countries,
    "top_countries": dashboard.top_countries,
    "confusion": evaluation.confusion,
    "label_status_breakdown": evaluation.label_status_breakdown,
    "label_status_matrix": evaluation.label_status_matrix,
    "label_profile": evaluation.label_profile,
}
STATUS_PANELS = {
    "kpi_block": dashboard.kpi_block,
    "status_distribution": dashboard.status_distribution,
    "final_score_histogram": dashboard.final_score_histogram,
    "probability_histogram": dashboard.probability_histogram,
    "behavior_distribution": dashboard.behavior_distribution,
    "method_distribution": dashboard.method_distribution,
}


def kept_cube(transactions: DataFrame) -> DataFrame:
    """The cube at one moment, written once to the shared folder; it serves every selection."""
    return durable(activity_cube(transactions))


def panels(cube: DataFrame, statuses: dashboard.Statuses = None, at: Column | None = None) -> dict[str, DataFrame]:
    """All breakdowns of a cube.

    ``statuses`` narrows the panels that follow the page's status selection; ``at`` is the evaluation time.
    """
    fixed = {name: panel(cube, m=CUBE) for name, panel in PANELS.items()}
    selected = {name: panel(cube, statuses, m=CUBE) for name, panel in STATUS_PANELS.items()}
    return {**fixed, **selected, "confusion_metrics": evaluation.confusion_metrics(cube, at, m=CUBE)}
