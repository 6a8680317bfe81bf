"""Exact measures of a scored, labelled table, as aggregates over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.session import durable


def area_under_roc(scored: DataFrame, score: str = "ml_probability", label: str = "actual_label") -> DataFrame:
    """``auc, positives, negatives``: the share of pairs of a positive and a negative row in which the positive scores higher.

    A tie counts half. Rows are first counted per distinct score. These counts are sorted over all tasks
    by range; each range adds up its own negatives, and the sums of the ranges before it, one number
    a range, are carried in. All counts are integers, so the result is exact up to its one division. It is
    null without rows of both classes; rows without a score or a label of 0 or 1 do not count.
    """
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    counted = known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )
    ranges = durable(counted.repartitionByRange("score").withColumn("range", F.spark_partition_id()))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("range").agg(F.sum("negatives").alias("inside"))  # a row a range
    carried = totals.select("range", F.coalesce(F.sum("inside").over(earlier), F.lit(0)).alias("carried"))
    lower = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("lower", F.coalesce(F.sum("negatives").over(lower), F.lit(0)))
    placed = placed.join(F.broadcast(carried), "range")
    won_twice = (F.col("lower") + F.col("carried")) * 2 + F.col("negatives")
    pairs = F.col("positives").cast("decimal(18,0)") * won_twice.cast("decimal(19,0)")
    summed = placed.agg(
        F.sum(pairs).cast("double").alias("won"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("positives", "negatives")]
    )
    every = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    return summed.select(F.try_divide("won", every).alias("auc"), "positives", "negatives")


def weighted_f1(scored: DataFrame, label: str | Column = "actual_label", prediction: str | Column = "prediction") -> DataFrame:
    """``f1, rows``: the F1 of every class, averaged by the class's share of the rows; 0.0 without rows.

    One aggregation to a confusion matrix, the rest on its cells. A class that is only predicted has no weight. Rows without label
    or prediction do not count.
    """
    label, prediction = (F.col(c) if isinstance(c, str) else c for c in (label, prediction))
    pairs = scored.select(label.cast("double").alias("label"), prediction.cast("double").alias("predicted")).dropna()
    cells = pairs.groupBy("label", "predicted").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("own"), F.lit(0).cast("bigint").alias("claimed"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("own"), F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("hits")),
    )
    classes = cells.select(F.inline(sides)).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("own", "claimed", "hits")])
    f1 = 2 * F.col("hits") / (F.col("own") + F.col("claimed"))
    return classes.agg(
        F.coalesce(F.try_divide(F.sum(F.col("own") * f1), F.sum("own")), F.lit(0.0)).alias("f1"),
        F.coalesce(F.sum("own"), F.lit(0)).alias("rows"),
    )
