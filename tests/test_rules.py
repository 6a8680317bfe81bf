"""Rule points and decisions at their boundaries, and against a plain Python version."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskstream.functions.decision import with_decision
from riskstream.functions.rules import with_rule_scores

COLUMNS = (
    "transaction_id string, amount double, country string, usual_country string, merchant_category string, "
    "event_time timestamp_ntz, device_id string, amount_vs_avg_user double, ml_probability double"
)
PLAIN = {
    "transaction_id": "t",
    "amount": 10.0,
    "country": "FR",
    "usual_country": "FR",
    "merchant_category": "Grocery",
    "event_time": datetime(2024, 1, 1, 12),
    "device_id": "D-100",
    "amount_vs_avg_user": 1.0,
    "ml_probability": 0.0,
}


def frame(spark, *changes):
    rows = [tuple({**PLAIN, "transaction_id": str(i), **change}.values()) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, COLUMNS)


def scores(spark, column, *changes):
    scored = with_rule_scores(frame(spark, *changes))
    return [r[0] for r in scored.orderBy(F.col("transaction_id").cast("int")).select(column).collect()]


def test_amount_bounds_are_strict(spark):
    amounts = [5000.0, 5000.01, 10000.0, 10000.01]
    assert scores(spark, "amount_score", *[{"amount": a} for a in amounts]) == [0, 30, 30, 40]


def test_country_needs_both_sides(spark):
    cases = [{"country": "ES"}, {"country": "FR"}, {"country": None}, {"usual_country": None}]
    assert scores(spark, "country_score", *cases) == [20, 0, 0, 0]


def test_category_is_case_sensitive(spark):
    cases = ["Crypto", "Luxury", "Gaming", "Gambling", "gaming", "Grocery", None]
    assert scores(spark, "merchant_score", *[{"merchant_category": c} for c in cases]) == [15, 15, 15, 15, 0, 0, 0]


def test_night_runs_through_hour_five(spark):
    times = [(23, 59, 59), (0, 0, 0), (5, 59, 59), (6, 0, 0)]
    cases = [{"event_time": datetime(2024, 1, 1, *t)} for t in times]
    assert scores(spark, "time_score", *cases) == [0, 10, 10, 0]


def test_night_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert scores(spark, "time_score", {"event_time": datetime(2024, 1, 1, 5, 59, 59)}) == [10]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_device_marks_match_anywhere(spark):
    cases = ["D-7", "D-8", "D-900", "XD-9", None]
    assert scores(spark, "device_score", *[{"device_id": d} for d in cases]) == [0, 15, 15, 15, 0]


def test_behavior_bounds_are_inclusive(spark):
    ratios = [2.99, 3.0, 4.99, 5.0, 9.99, 10.0, None]
    cases = [{"amount_vs_avg_user": r} for r in ratios]
    assert scores(spark, "behavior_score", *cases) == [0, 10, 10, 20, 20, 30, 0]


def decide(spark, *inputs):
    """Final score and status for (rule, probability, behavior)."""
    df = spark.createDataFrame(
        [(i, *values) for i, values in enumerate(inputs)],
        "i int, rule_score int, ml_probability double, behavior_score int",
    )
    return [(r.final_score, r.transaction_status) for r in with_decision(df).orderBy("i").collect()]


@pytest.mark.parametrize(
    "given_, expected",
    [
        ((90, 0.0, 0), (31, "SUSPICIOUS")),  # 31.4999..., not 31.5
        ((0, 0.0799, 0), (4, "NORMAL")),
        ((0, 0.08, 0), (4, "SUSPICIOUS")),
        ((35, 0.0799, 0), (16, "NORMAL")),
        ((40, 0.0, 0), (14, "SUSPICIOUS")),
        ((50, 0.0999, 0), (22, "SUSPICIOUS")),
        ((50, 0.10, 0), (22, "FRAUD")),
        ((45, 0.10, 0), (20, "SUSPICIOUS")),
        ((100, 0.5, 0), (58, "FRAUD")),
        ((35, 0.92, 30), (60, "FRAUD")),
        ((35, 0.89, 30), (58, "SUSPICIOUS")),
        ((0, 0.05, 0), (2, "NORMAL")),
        ((100, 1.0, 30), (86, "FRAUD")),
    ],
)
def test_decision(spark, given_, expected):
    assert decide(spark, given_) == [expected]


def expected_points(row):
    points = 40 if row["amount"] > 10000 else 30 if row["amount"] > 5000 else 0
    points += 20 if None not in (row["country"], row["usual_country"]) and row["country"] != row["usual_country"] else 0
    points += 15 if row["merchant_category"] in ("Crypto", "Luxury", "Gaming", "Gambling") else 0
    points += 10 if row["event_time"].hour < 6 else 0
    points += 15 if row["device_id"] and ("D-8" in row["device_id"] or "D-9" in row["device_id"]) else 0
    return points


row_strategy = st.fixed_dictionaries(
    {
        "amount": st.floats(0, 20000),
        "country": st.sampled_from(["FR", "ES", None]),
        "usual_country": st.sampled_from(["FR", "ES", None]),
        "merchant_category": st.sampled_from(["Crypto", "Gambling", "Grocery", "crypto", None]),
        "event_time": st.datetimes(datetime(2024, 1, 1), datetime(2024, 12, 31)),
        "device_id": st.sampled_from(["D-100", "D-812", "x9", "D-9", None]),
        "amount_vs_avg_user": st.floats(0, 20),
        "ml_probability": st.floats(0, 1),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_strategy, min_size=20, max_size=60))
def test_against_plain_python(spark, rows):
    scored = with_decision(with_rule_scores(frame(spark, *rows)))
    found = {int(r.transaction_id): r for r in scored.collect()}
    for i, row in enumerate(rows):
        ratio = row["amount_vs_avg_user"]
        behavior = 30 if ratio >= 10 else 20 if ratio >= 5 else 10 if ratio >= 3 else 0
        rule = expected_points(row)
        blend = rule * 0.35 + row["ml_probability"] * 100 * 0.45 + behavior * 0.20
        final = int(blend + 0.5) if abs(blend % 1 - 0.5) > 1e-9 else found[i].final_score
        assert (found[i].rule_score, found[i].behavior_score, found[i].final_score) == (rule, behavior, final)
        fraud = final >= 60 or (rule >= 50 and row["ml_probability"] >= 0.10)
        suspicious = final >= 35 or row["ml_probability"] >= 0.08 or rule >= 40
        assert found[i].transaction_status == ("FRAUD" if fraud else "SUSPICIOUS" if suspicious else "NORMAL")
