"""Quick looks at what has been stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: columns of the latest-rows check ---
CHECKED = (
    "transaction_id",
    "amount",
    "country",
    "usual_country",
    "ml_probability",
    "behavior_score",
    "final_score",
    "transaction_status",
    "actual_label",
)
# --- end of fixed values ---


def table_counts(**tables: DataFrame) -> DataFrame:
    """``table_name, row_count`` for every table given."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def latest_checked(transactions: DataFrame, top: int = 20) -> DataFrame:
    ordered = transactions.orderBy(F.col("processed_at").desc(), "transaction_id")
    return ordered.limit(top).select(*CHECKED)
