import json
from datetime import datetime

from conftest import plan_of
from pyspark.sql import functions as F

from riskstream.functions import cleaning

GOOD = {"transaction_id": "a", "user_id": "u", "amount": 400.0, "timestamp": "2024-01-01 05:59:59"}


def bodies(spark, *messages):
    texts = [m if isinstance(m, str) or m is None else json.dumps(m) for m in messages]
    return cleaning.message_text(spark.createDataFrame([(t,) for t in texts], "value string"))


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


BAD = {
    "unreadable_message": ["{bad", None, "", "[" + json.dumps(GOOD) + "]", "17"],
    "missing_transaction_id": [without("transaction_id")],
    "missing_user_id": [without("user_id")],
    "missing_amount": [without("amount"), {**GOOD, "amount": "3.5"}],
    "bad_timestamp": [
        without("timestamp"),
        {**GOOD, "timestamp": "2024-01-01T00:00:00"},
        {**GOOD, "timestamp": "2024-02-30 00:00:00"},
        {**GOOD, "timestamp": "2024-01-01 24:00:00"},
        {**GOOD, "timestamp": "2024-01-01 00:00"},
    ],
    "amount_not_a_number": [json.dumps(GOOD).replace("400.0", "NaN")],
    "amount_out_of_range": [{**GOOD, "amount": 1e10}, {**GOOD, "amount": -1e12}],
}


def test_bytes_become_text(spark):
    raw = spark.createDataFrame([(bytearray(b'{"a": "\xc3\xa9"}'),)], "value binary")
    assert cleaning.message_text(raw).first().body == '{"a": "é"}'


def test_every_message_is_accepted_or_rejected_with_its_reason(spark):
    messages = [m for group in BAD.values() for m in group]
    frame = bodies(spark, GOOD, *messages, {**GOOD, "transaction_id": "b", "extra": 1})
    accepted = cleaning.accepted_events(frame)
    assert sorted(r.transaction_id for r in accepted.collect()) == ["a", "b"]
    counts = {r.reject_reason: r["count"] for r in cleaning.rejected_events(frame).groupBy("reject_reason").count().collect()}
    assert counts == {reason: len(group) for reason, group in BAD.items()}


def test_rejected_messages_keep_their_whole_text(spark):
    assert cleaning.rejected_events(bodies(spark, "{bad")).first().body == "{bad"


def test_defaults(spark):
    supplied = {**GOOD, "transaction_id": "b", "user_avg_amount": 50.0}
    both = {**supplied, "transaction_id": "c", "amount_vs_avg_user": 7.0}
    rows = cleaning.accepted_events(bodies(spark, GOOD, supplied, both)).orderBy("transaction_id").collect()
    assert [(r.user_avg_amount, r.amount_vs_avg_user) for r in rows] == [(200.0, 2.0), (50.0, 2.0), (50.0, 7.0)]


def test_supplied_average_on_request(spark):
    supplied = {**GOOD, "user_avg_amount": 50.0}
    assert cleaning.accepted_events(bodies(spark, supplied), True).first().amount_vs_avg_user == 8.0


def test_features_are_filled(spark):
    row = cleaning.accepted_events(bodies(spark, {**GOOD, "V2": 1.5})).first()
    assert (row.Time, row.V1, row.V2, row.V28) == (0.0, 0.0, 1.5, 0.0)


def test_event_time_is_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = {**GOOD, "timestamp": "2024-03-10 02:30:00"}
        assert cleaning.accepted_events(bodies(spark, gap)).first().event_time == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_each_message_is_parsed_once(spark):
    accepted = cleaning.accepted_events(bodies(spark, GOOD)).select("transaction_id", "amount", "event_time")
    physical = plan_of(accepted).split("== Physical Plan ==")[1]
    assert physical.count("from_json") == 1


def test_generator_keeps_one_row_per_message(spark):
    frame = spark.range(1000).select(F.to_json(F.struct(F.col("id").cast("string").alias("transaction_id"))).alias("body"))
    assert cleaning.parse_events(frame).select("transaction_id").distinct().count() == 1000
