"""Labelled card data in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskstream.functions.predicates import in_class
from riskstream.operators.rebalance import class_counts, require_both_classes
from riskstream.schemas import LABEL, LABELLED


def labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan a labelled CSV whose header names the columns in any order.

    Only the header is read to learn the order; types come from the declared schema, so
    there is no inference pass over the data. Undeclared columns are not read.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in LABELLED.names if name not in header]
    if missing:
        raise ValueError(f"columns not found in {path}: {', '.join(missing)}")
    declared = {field.name: field.dataType for field in LABELLED}
    schema = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in header])
    return spark.read.option("header", True).schema(schema).csv(path).select(*LABELLED.names)


def replay_source(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Normal and fraud rows of a labelled CSV, both checked to be non-empty."""
    labelled = labelled_csv(spark, path)
    require_both_classes(*class_counts(labelled))
    return labelled.filter(in_class(0, LABEL)), labelled.filter(in_class(1, LABEL))


def complete_rows(labelled: DataFrame) -> DataFrame:
    """Rows without a null or NaN in any feature or in the label."""
    return labelled.select(*LABELLED.names).dropna()
