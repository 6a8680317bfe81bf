"""Joins, dedupe and reconciliation against brute force, with hot keys."""

import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from riskstream.operators import dedupe, reconcile, rebalance
from riskstream.operators.enrich import with_profile
from riskstream.operators.lookup import fits_broadcast, lookup, row_bytes


def hot_fact(spark, rows=3000):
    """A third of the rows under one key, a tenth without a key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise(F.concat(F.lit("k"), n % 50))
    return spark.range(rows).select(n.alias("n"), key.alias("user_id"), (n * 1.5).alias("amount"))


def dimension(spark):
    names = ["hot"] + [f"k{i}" for i in range(40)]
    return spark.createDataFrame([(name, f"c{i}", float(i)) for i, name in enumerate(names)], "user_id string, usual_country string, avg_amount double")


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_beyond_broadcast_equals_plain_join(spark, how):
    fact, dim = hot_fact(spark), dimension(spark)
    plain = fact.join(dim, "user_id", how)
    sliced = lookup(fact, dim, "user_id", how, broadcast_bytes=10, rows_per_slice=100)
    assert rows_of(sliced) == rows_of(plain)


def test_lookup_spreads_the_hot_key(spark):
    fact, dim = hot_fact(spark), dimension(spark)
    sliced = lookup(fact, dim, "user_id", broadcast_bytes=10, rows_per_slice=100, spread_by="n")
    joins = plan_of(sliced).split("== Physical Plan ==")[1]
    assert re.search(r"Join \[user_id#\d+, _slice#\d+\]", joins)
    hot = fact.filter("user_id = 'hot'").select(F.pmod(F.xxhash64("n"), F.lit(10)).alias("s")).groupBy("s").count()
    counts = [r["count"] for r in hot.collect()]
    assert len(counts) == 10 and max(counts) < 200


def test_lookup_broadcasts_a_small_dimension(spark):
    fact, dim = hot_fact(spark), dimension(spark)
    size = 41 * row_bytes(dim.schema)
    assert fits_broadcast(dim, size) and not fits_broadcast(dim, size - 1)
    assert "BroadcastHashJoin" in plan_of(lookup(fact, dim, "user_id"))


def test_profile_ratio_has_a_floor(spark):
    events = spark.createDataFrame([("k0", 3.0), ("k9", 20.0), ("unknown", 1.0)], "user_id string, amount double")
    profiles = spark.createDataFrame([("k0", "FR", 0.2), ("k9", "ES", 10.0)], "user_id string, usual_country string, avg_amount double")
    rows = with_profile(events, profiles).orderBy("user_id").collect()
    assert [(r.user_id, r.usual_country, r.amount_vs_avg_user) for r in rows] == [("k0", "FR", 3.0), ("k9", "ES", 2.0)]


def test_keep_first_is_stable_and_limited_before_the_shuffle(spark):
    n = F.col("id")
    ids = F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), n % 200))
    df = spark.range(3000).select(ids.alias("transaction_id"), (n % 7).alias("event_time"), n.alias("payload"))
    first = dedupe.keep_first(df)
    assert rows_of(first) == rows_of(dedupe.keep_first(df.repartition(13, "payload")))
    assert first.count() == df.select("transaction_id").distinct().count()
    earliest = {r[0]: r[1] for r in df.groupBy("transaction_id").agg(F.min("event_time")).collect()}
    assert all(earliest[r.transaction_id] == r.event_time for r in first.collect())
    physical = plan_of(first).split("== Physical Plan ==")[1]
    assert "WindowGroupLimit" in physical and "Partial" in physical


@pytest.mark.parametrize("limit", [5, 10_000])
def test_drop_stored_by_broadcast_and_by_shuffle(spark, limit):
    new = spark.range(100).select(F.concat(F.lit("t"), F.col("id")).alias("transaction_id"), "id")
    stored = spark.range(50, 5000).select(F.concat(F.lit("t"), F.col("id")).alias("transaction_id"))
    left = dedupe.drop_stored(new, stored, broadcast_bytes=limit)
    assert sorted(r.id for r in left.collect()) == list(range(50))


def tables(spark):
    """Transactions and alerts with hot, duplicate and null ids."""
    n = F.col("id")
    tx_id = F.when(n % 3 == 0, "hot").when(n % 7 == 0, None).otherwise(F.concat(F.lit("t"), n))
    status = F.when(n % 2 == 0, "FRAUD").when(n % 5 == 0, "SUSPICIOUS").otherwise("NORMAL")
    tx = spark.range(900).select(tx_id.alias("transaction_id"), status.alias("transaction_status"), n.alias("n"))
    alert_id = F.when(n % 4 == 0, None).when(n % 9 == 0, F.concat(F.lit("gone"), n)).otherwise(F.concat(F.lit("t"), n))
    alerts = spark.range(600).select(alert_id.alias("transaction_id"), n.alias("alert_no"))
    return tx, alerts


def test_reconcile_against_brute_force(spark):
    tx, alerts = tables(spark)
    tx_rows, alert_rows = tx.collect(), alerts.collect()
    tx_ids = {r.transaction_id for r in tx_rows} - {None}
    alert_ids = {r.transaction_id for r in alert_rows} - {None}
    orphans = [r for r in alert_rows if r.transaction_id not in tx_ids]
    silent = [r for r in tx_rows if r.transaction_status != "NORMAL" and r.transaction_id not in alert_ids]
    repeated = [k for k, c in Counter(r.transaction_id for r in tx_rows).items() if c > 1]
    counts = reconcile.key_checks(tx, alerts).first()
    assert counts.asDict() == {
        "duplicated_transaction_id": len(repeated),
        "fraud_alert_without_transaction": len(orphans),
        "fraud_transaction_without_alert": len(silent),
    }
    assert {r.alert_no for r in reconcile.alerts_without_transaction(alerts, tx).collect()} == {r.alert_no for r in orphans}
    assert {r.n for r in reconcile.transactions_without_alert(tx, alerts).collect()} == {r.n for r in silent}
    assert {r.transaction_id for r in reconcile.duplicated_ids(tx).collect()} == set(repeated)


def test_reconcile_counts_before_its_only_shuffle(spark):
    physical = plan_of(reconcile.key_checks(*tables(spark))).split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in physical and "Join" not in physical


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 5, "rows_per_slice": 20}])
def test_rows_without_partner_by_broadcast_and_by_slices(spark, options):
    tx, alerts = tables(spark)
    plain = tx.join(alerts.select("transaction_id"), "transaction_id", "left_anti")
    found = reconcile.rows_without_partner(tx, alerts, **options)
    assert rows_of(found) == rows_of(plain)
    physical = plan_of(found).split("== Physical Plan ==")[1]
    assert ("_slice" in physical) == bool(options)


def test_hot_ids_with_a_partner_are_spread_too(spark):
    tx, alerts = tables(spark)
    alerts = alerts.unionByName(spark.range(400).select(F.lit("hot").alias("transaction_id"), "id").withColumnRenamed("id", "alert_no"))
    plain = tx.join(alerts.select("transaction_id"), "transaction_id", "left_anti")
    found = reconcile.rows_without_partner(tx, alerts, broadcast_bytes=5, rows_per_slice=20)
    assert rows_of(found) == rows_of(plain)


def labelled(spark):
    return spark.range(2000).select(F.col("id").alias("n"), (F.col("id") % 20 == 0).cast("int").alias("Class"))


def test_class_weights_balance(spark):
    weighted = rebalance.with_class_weight(labelled(spark))
    sums = {r.Class: r.w for r in weighted.groupBy("Class").agg(F.sum("class_weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(1000) and sums[1] == pytest.approx(1000)


def test_hash_split_is_a_partition_and_ignores_layout(spark):
    df = labelled(spark)
    train, held_out = rebalance.hash_split(df, "n")
    again, _ = rebalance.hash_split(df.repartition(7, "Class"), "n")
    assert train.count() + held_out.count() == 2000
    assert train.intersect(held_out).count() == 0
    assert rows_of(train) == rows_of(again)
    assert 0.75 < train.count() / 2000 < 0.85


@pytest.mark.parametrize("share, kept_whole", [(0.20, 1), (0.02, 0)])
def test_rebalance_reaches_the_share(spark, share, kept_whole):
    df = labelled(spark)
    sample = rebalance.rebalance(df, "n", fraud_share=share)
    normal, fraud = rebalance.class_counts(sample)
    assert fraud / (normal + fraud) == pytest.approx(share, abs=0.05 if share > 0.1 else 0.01)
    assert sample.filter(F.col("Class") == kept_whole).count() == df.filter(F.col("Class") == kept_whole).count()


def test_empty_class_is_an_error(spark):
    with pytest.raises(ValueError, match="no fraud rows"):
        rebalance.with_class_weight(labelled(spark).filter("Class = 0"))
