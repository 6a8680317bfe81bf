"""Explainable rule points and the spend-behavior score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: thresholds and points of the scoring contract ---
AMOUNT_BANDS = ((10_000, 40), (5_000, 30))  # strictly above
RATIO_BANDS = ((10, 30), (5, 20), (3, 10))  # at or above
FOREIGN_COUNTRY_POINTS = 20
RISKY_CATEGORIES = ("Crypto", "Luxury", "Gaming", "Gambling")
RISKY_CATEGORY_POINTS = 15
LAST_NIGHT_HOUR = 5
NIGHT_POINTS = 10
RISKY_DEVICE_MARKS = ("D-8", "D-9")
RISKY_DEVICE_POINTS = 15
FREQUENCY_POINTS = 0
# --- end of fixed values ---


def _points_if(condition: Column, points: int) -> Column:
    """Points when the condition holds; a null condition scores nothing."""
    return F.when(condition, points).otherwise(0)


def _first_band(bands, reached) -> Column:
    """Points of the first band reached, else zero."""
    return reduce(
        lambda rest, band: F.when(reached(band[0]), band[1]).otherwise(rest),
        reversed(bands),
        F.lit(0),
    )


def amount_score() -> Column:
    return _first_band(AMOUNT_BANDS, lambda bound: F.col("amount") > bound)


def country_score() -> Column:
    return _points_if(F.col("country") != F.col("usual_country"), FOREIGN_COUNTRY_POINTS)


def merchant_score() -> Column:
    return _points_if(F.col("merchant_category").isin(*RISKY_CATEGORIES), RISKY_CATEGORY_POINTS)


def time_score() -> Column:
    return _points_if(F.hour("event_time") <= LAST_NIGHT_HOUR, NIGHT_POINTS)


def device_score() -> Column:
    marked = reduce(Column.__or__, [F.col("device_id").contains(mark) for mark in RISKY_DEVICE_MARKS])
    return _points_if(marked, RISKY_DEVICE_POINTS)


def frequency_score() -> Column:
    return F.lit(FREQUENCY_POINTS)


def behavior_score() -> Column:
    return _first_band(RATIO_BANDS, lambda bound: F.col("amount_vs_avg_user") >= bound)


RULES = {
    "amount_score": amount_score,
    "country_score": country_score,
    "merchant_score": merchant_score,
    "time_score": time_score,
    "device_score": device_score,
    "frequency_score": frequency_score,
}


def rule_score() -> Column:
    return reduce(Column.__add__, [F.col(name) for name in RULES])


def with_rule_scores(events: DataFrame) -> DataFrame:
    """All rule points, their sum and the behavior score.

    Two projections, not one per column: the analyzer walks the plan twice, and Catalyst
    folds both into a single codegen stage with the parse and the filters.
    """
    points = {name: build() for name, build in RULES.items()}
    return events.withColumns({**points, "behavior_score": behavior_score()}).withColumn(
        "rule_score", rule_score()
    )
