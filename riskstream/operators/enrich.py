"""User-profile enrichment of raw spend events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.operators.lookup import lookup

SMALLEST_AVERAGE = 1.0  # fixed value: averages below it count as this much


def with_profile(events: DataFrame, profiles: DataFrame, **lookup_options) -> DataFrame:
    """Attach the user's usual country and average, and the amount's ratio to that average.

    ``profiles`` has ``user_id, usual_country, avg_amount``; events of unknown users drop out.
    """
    profile = profiles.select("user_id", "usual_country", F.col("avg_amount").alias("user_avg_amount"))
    joined = lookup(events, profile, "user_id", **lookup_options)
    ratio = F.col("amount") / F.greatest(F.col("user_avg_amount"), F.lit(SMALLEST_AVERAGE))
    return joined.withColumn("amount_vs_avg_user", ratio)


def _cents() -> Column:
    return F.round(F.col("amount") * 100).try_cast("decimal(20,0)")


def spend_totals(events: DataFrame) -> DataFrame:
    """user_id, spent, row_count: what each user spent, in cents, and in how many rows with an amount."""
    known = events.filter(F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
    sums = known.withColumn("_cents", _cents()).groupBy("user_id")
    return sums.agg(F.coalesce(F.sum("_cents"), F.lit(0)).cast("decimal(20,0)").alias("spent"), F.count("_cents").alias("row_count"))


def with_running_average(events: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Attach ``user_avg_amount``, the average of what the user spent before, and the amount's ratio to it.

    Before means earlier by ``event_time``, of equals by ``transaction_id``; the row itself does not count. Without
    earlier rows both are null. Amounts are added as cents, so the averages do not depend on how
    rows are spread. A user's days are added up first and then the rows of each day, so a user with much
    of the table is dealt out by day. Rows without a user or a time have no history and are no one's. ``carried``
    (as :func:`spend_totals` gives it, a row a user) stands for rows before all of ``events``.
    """
    named = events.withColumns({"_day": F.to_date("event_time"), "_cents": _cents()})
    known = named.filter(F.col("user_id").isNotNull() & F.col("_day").isNotNull())
    sums = [F.sum("_cents").alias("_spent"), F.count("_cents").alias("_n")]
    days = known.groupBy("user_id", "_day").agg(*sums)
    earlier_days = Window.partitionBy("user_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    totals = days.select("user_id", "_day", *[F.sum(c).over(earlier_days).alias(f"{c}_before") for c in ("_spent", "_n")])
    if carried is not None:
        totals = totals.join(carried.select("user_id", "spent", "row_count"), "user_id", "left").withColumns(
            {
                "_spent_before": F.coalesce("_spent_before", F.lit(0)) + F.coalesce("spent", F.lit(0)),
                "_n_before": F.coalesce("_n_before", F.lit(0)) + F.coalesce("row_count", F.lit(0)),
            }
        ).drop("spent", "row_count")
    same_day = Window.partitionBy("user_id", "_day").orderBy("event_time", "transaction_id")
    same_day = same_day.rowsBetween(Window.unboundedPreceding, -1)
    inside = known.withColumns({"_spent": F.sum("_cents").over(same_day), "_n": F.count("_cents").over(same_day)})
    joined = inside.join(totals, ["user_id", "_day"])

    def both(name: str):
        return F.coalesce(name, F.lit(0)) + F.coalesce(f"{name}_before", F.lit(0))

    average = F.try_divide(both("_spent").cast("double") / 100, both("_n"))
    averaged = joined.withColumn("user_avg_amount", average).select(*events.columns, "user_avg_amount")
    others = named.filter(F.col("user_id").isNull() | F.col("_day").isNull()).select(*events.columns)
    every = averaged.unionByName(others.withColumn("user_avg_amount", F.lit(None).cast("double")))
    ratio = F.col("amount") / F.greatest(F.col("user_avg_amount"), F.lit(SMALLEST_AVERAGE))
    return every.withColumn("amount_vs_avg_user", F.when(F.col("user_avg_amount").isNotNull(), ratio))
