"""Class balance of labelled tables: counts, weights, splits and target shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.functions.hashing import BUCKET_SPACE, hash_below, hash_bucket
from riskstream.functions.predicates import in_class


def class_counts(labelled: DataFrame) -> tuple[int, int]:
    """Rows of class 0 and class 1, in one pass."""
    counts = labelled.agg(
        F.count_if(in_class(0)).alias("normal"), F.count_if(in_class(1)).alias("fraud")
    ).first()
    return counts["normal"], counts["fraud"]


def require_both_classes(normal: int, fraud: int) -> None:
    for name, rows in (("normal", normal), ("fraud", fraud)):
        if rows == 0:
            raise ValueError(f"no {name} rows (class {int(name == 'fraud')}) in the labelled table")


def with_class_weight(labelled: DataFrame, counts: tuple[int, int] | None = None) -> DataFrame:
    """Weights under which both classes weigh half of the table."""
    normal, fraud = counts or class_counts(labelled)
    require_both_classes(normal, fraud)
    total = normal + fraud
    weight = F.when(in_class(1), total / (2.0 * fraud)).otherwise(total / (2.0 * normal))
    return labelled.withColumn("class_weight", weight)


def random_split(df: DataFrame, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded random split; its outcome depends on the partitioning of ``df``."""
    first, second = df.randomSplit([share, 1.0 - share], seed)
    return first, second


def hash_split(df: DataFrame, *keys: str, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split by key hash: the same rows for any partitioning, file order or retry."""
    chosen = hash_below(share, *keys, seed=seed)
    return df.filter(chosen), df.filter(~chosen)


def rebalance(df: DataFrame, *keys: str, fraud_share: float = 0.20, seed: int = 42) -> DataFrame:
    """A hash sample of ``df`` whose fraud share is about ``fraud_share``.

    The class that is too frequent is thinned, the other is kept whole.
    """
    normal, fraud = class_counts(df)
    require_both_classes(normal, fraud)
    keep_normal = fraud * (1.0 - fraud_share) / (fraud_share * normal)
    keep_fraud = 1.0
    if keep_normal > 1.0:
        keep_normal, keep_fraud = 1.0, 1.0 / keep_normal
    bucket = hash_bucket(*keys, seed=seed)
    limit = F.when(in_class(1), int(keep_fraud * BUCKET_SPACE)).otherwise(int(keep_normal * BUCKET_SPACE))
    return df.filter(bucket < limit)
