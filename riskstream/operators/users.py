"""The user dimension, learned from what users have done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.predicates import is_alertable, is_fraud
from riskstream.schemas import USERS

# A user is HIGH from this share of frauds on, else MEDIUM from this share of alertable transactions on, else LOW.
HIGH_FRAUDS, MEDIUM_ALERTS = 0.05, 1 / 3
_COUNTS = ("row_count", "fraud_count", "alert_count", "amount_count", "amount_sum")


def user_history(transactions: DataFrame) -> DataFrame:
    """user_id, country and counts: what the dimension is made of, one row for a user and country.

    Histories of separate rows add up (:func:`merged`), so a day's rows are folded into what is kept without
    another look at the past. Rows are counted before they are moved, so a user with much of the
    table sends a row per task. Rows without a user take no part.
    """
    counts = {
        "row_count": F.count(F.lit(1)),
        "fraud_count": F.count_if(is_fraud()),
        "alert_count": F.count_if(is_alertable()),
        "amount_count": F.count("amount"),
        "amount_sum": F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(22,2)"),
    }
    known = transactions.filter(F.col("user_id").isNotNull())
    return known.groupBy("user_id", "country").agg(*[c.alias(name) for name, c in counts.items()])


def merged(*histories: DataFrame) -> DataFrame:
    """Several histories as one."""
    every = histories[0]
    for history in histories[1:]:
        every = every.unionByName(history)
    sums = every.groupBy("user_id", "country").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    return sums.withColumn("amount_sum", F.col("amount_sum").cast("decimal(22,2)"))


def risk_level() -> Column:
    rows = F.col("row_count")
    return (
        F.when(F.col("fraud_count") >= HIGH_FRAUDS * rows, "HIGH")
        .when(F.col("alert_count") >= MEDIUM_ALERTS * rows, "MEDIUM")
        .otherwise("LOW")
    )


def rated_users(history: DataFrame) -> DataFrame:
    """user_id, usual_country, avg_amount, risk_level: a row for each user of a history.

    The usual country is the one with most rows, of equals the first in the alphabet; null if none is known.
    """
    common = F.min_by("country", F.when(F.col("country").isNotNull(), F.struct(-F.col("row_count"), "country")))
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    per_user = history.groupBy("user_id").agg(common.alias("usual_country"), *sums)
    average = F.try_divide(F.col("amount_sum").cast("double"), F.col("amount_count"))
    return per_user.withColumns({"avg_amount": average, "risk_level": risk_level()}).select(*USERS.names)
