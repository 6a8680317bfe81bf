"""Exact model measures, learned users, running averages and joins in buckets, against plain versions."""

import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from checks import queries
from riskstream.operators import users
from riskstream.operators.enrich import with_running_average
from riskstream.plans import metrics, training
from riskstream.schemas import LABEL
from riskstream.sources import bucketed


def brute_auc(rows):
    high, low = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in high for b in low) / (len(high) * len(low))


@pytest.mark.parametrize("values", [3, 40, 10**6])
def test_area_under_roc_with_ties(spark, values):
    rng = random.Random(values)
    rows = [(rng.randrange(values) / 7 + y * 0.1, y) for y in (rng.randrange(2) for _ in range(700))]
    noise = [(None, 1), (0.5, None), (0.5, 2)]
    found = metrics.area_under_roc(spark.createDataFrame(rows + noise, "ml_probability double, actual_label int")).first()
    assert found.auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert found.positives + found.negatives == 700


def test_area_under_roc_needs_both_classes(spark):
    kind = "ml_probability double, actual_label int"
    assert metrics.area_under_roc(spark.createDataFrame([(0.5, 1)], kind)).first().auc is None
    assert metrics.area_under_roc(spark.createDataFrame([], kind)).first().auc is None


def test_area_under_roc_sorts_in_ranges(spark):
    """No window over all scores: the only one without a key runs over the ranges' sums."""
    rows = spark.range(50000).select(F.rand(1).alias("ml_probability"), (F.col("id") % 2).cast("int").alias("actual_label"))
    result = metrics.area_under_roc(rows)
    assert abs(result.first().auc - 0.5) < 0.02
    plan = plan_of(result).split("== Physical Plan ==")[1]
    assert plan.count("Exchange SinglePartition") <= 2 and "hashpartitioning(range" in plan


def test_measures_agree_with_the_evaluators(spark, sf):
    predictions = queries._training(spark, sf).predictions
    auc = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC").evaluate(predictions)
    f1 = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1").evaluate(predictions)
    assert training.area_under_roc(predictions) == pytest.approx(auc, abs=1e-9)
    assert training.weighted_f1(predictions) == pytest.approx(f1, abs=1e-12)


def test_weighted_f1_of_many_classes(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(5)), float(rng.randrange(7))) for _ in range(900)]
    found = metrics.weighted_f1(spark.createDataFrame(rows + [(None, 1.0), (1.0, None)], "actual_label double, prediction double"))
    own, claimed, hits = Counter(y for y, _ in rows), Counter(p for _, p in rows), Counter(y for y, p in rows if y == p)
    expected = sum(own[c] * 2 * hits[c] / (own[c] + claimed[c]) for c in own) / 900
    assert found.first().f1 == pytest.approx(expected, abs=1e-12) and found.first().rows == 900
    assert metrics.weighted_f1(spark.createDataFrame([], "actual_label double, prediction double")).first().f1 == 0.0


# ---------------------------------------------------------------- users


def test_every_user_is_rated(spark, sf):
    tx = queries.transactions(spark, sf)
    rated = users.rated_users(users.user_history(tx))
    assert rated.count() == tx.select("user_id").distinct().count()
    assert rated.filter("risk_level IS NULL OR usual_country IS NULL").isEmpty()


def test_levels_modes_and_unknown_values(spark):
    rows = (
        [("a", "X", "FRAUD", 1.0)] + [("a", "Y", "NORMAL", 2.0)] * 19
        + [("b", "Y", "SUSPICIOUS", None), ("b", "X", "NORMAL", None), ("b", None, "NORMAL", None)]
        + [("c", None, "NORMAL", 5.0)] * 4 + [(None, "X", "FRAUD", 9.0)]
    )
    tx = spark.createDataFrame(rows, "user_id string, country string, transaction_status string, amount double")
    tx = tx.withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    found = {r.user_id: (r.usual_country, r.avg_amount, r.risk_level) for r in users.rated_users(users.user_history(tx)).collect()}
    assert found == {"a": ("Y", 1.95, "HIGH"), "b": ("X", None, "MEDIUM"), "c": (None, 5.0, "LOW")}


def test_histories_add_up(spark, sf):
    tx = queries.transactions(spark, sf).withColumn("part", F.pmod(F.xxhash64("transaction_id"), F.lit(3)))
    whole = users.user_history(tx)
    parts = users.merged(*[users.user_history(tx.filter(F.col("part") == k)) for k in range(3)])
    assert sorted(map(str, parts.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


# ---------------------------------------------------------------- running averages


def test_running_average_leaves_the_row_itself_out(spark):
    """One user has most rows, with ties in time, over several days."""
    rng, start = random.Random(2), datetime(2024, 1, 1)
    rows = []
    for k in range(400):
        user = "hot" if k % 3 else rng.choice(["u", "v", None])
        at = None if k % 50 == 7 else start + timedelta(hours=rng.randrange(100))
        rows.append((f"T{k:03}", user, at, None if k % 41 == 3 else rng.randrange(1, 10**6) / 100))
    events = spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp_ntz, amount double")
    found = {r.transaction_id: r for r in with_running_average(events).collect()}
    assert len(found) == 400
    by_user = defaultdict(list)
    for name, user, at, amount in rows:
        if user is None or at is None:
            assert found[name].user_avg_amount is None
        else:
            by_user[user].append((at, name, amount))
    for history in by_user.values():
        history.sort(key=lambda r: r[:2])
        for k, (_, name, amount) in enumerate(history):
            before = [round(a * 100) for _, _, a in history[:k] if a is not None]
            expected = sum(before) / 100 / len(before) if before else None
            assert found[name].user_avg_amount == expected
            if amount is not None and expected is not None:
                assert found[name].amount_vs_avg_user == amount / max(expected, 1.0)


def test_a_hot_user_is_dealt_by_day(spark):
    events = spark.range(1000).selectExpr(
        "cast(id as string) transaction_id", "concat('hot', id % 1) user_id", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,cast(id % 500 as int)) event_time",
        "1.0D amount",
    )
    plan = plan_of(with_running_average(events)).split("== Physical Plan ==")[1]
    windows = re.findall(r"Window \[.*?\], \[(user_id#\d+(?:, _day#\d+)?)\]", plan)
    assert sorted(w.count("#") for w in windows) == [1, 2]  # days of a user, rows of a user's day
    assert "HashAggregate(keys=[user_id#" in plan and "partial_sum" in plan
    assert with_running_average(events).filter("user_avg_amount IS NULL").count() == 1


# ---------------------------------------------------------------- buckets


def test_joins_of_bucketed_tables_move_nothing(spark, sf):
    for name in ("j01_alerts_without_transaction_bucketed", "j03_missing_alerts_bucketed"):
        found = queries.REGISTRY[name](spark, sf)
        plan = plan_of(found).split("== Physical Plan ==")[1]
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    lost = queries.REGISTRY["j01_alerts_without_transaction_bucketed"](spark, sf)
    plain = queries.REGISTRY["j01_alerts_without_transaction"](spark, sf)
    assert sorted(map(str, lost.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_keys_that_are_null_or_fill_a_table(spark, tmp_path):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'hot' ELSE cast(id AS string) END AS transaction_id", "id")
    others = spark.range(3000).selectExpr("CASE WHEN id % 2 = 0 THEN cast(id AS string) WHEN id % 3 = 0 THEN 'hot' END AS transaction_id")
    for name, frame in (("bucket_rows", rows), ("bucket_others", others)):
        bucketed.write_bucketed(frame, name, str(tmp_path / name), buckets=8)
    found = {r.id for r in bucketed.rows_without_partner(spark, "bucket_rows", "bucket_others").collect()}
    assert found == {k for k in range(3000) if k % 3 == 0 or (k % 3 == 2 and k % 2)}
    sizes = [r["count"] for r in spark.table("bucket_rows").filter("transaction_id IS NULL").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 250  # null keys are written by all tasks
