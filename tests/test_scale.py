"""Work is dealt out to tasks whatever the files look like, and costly frames are made once."""

import pyarrow as pa
import pyarrow.parquet as pq
from conftest import plan_of
from pyspark.sql import functions as F

from checks import derived, queries


def _rows_per_task(df):
    counted = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return [row["count"] for row in counted]


def _one_row_group(folder, rows):
    table = pa.table({"event_id": [None, *range(rows - 2), 7], "value": [1.5] * rows})
    pq.write_table(table, f"{folder}/rows.parquet", row_group_size=rows)
    return f"{folder}/rows.parquet"


def test_a_single_row_group_is_dealt_to_many_tasks(spark, tmp_path):
    rows = spark.read.parquet(_one_row_group(tmp_path, 10_000))
    assert max(_rows_per_task(rows)) == 10_000
    dealt = derived.spread(rows, rows_per_task=1_000)
    assert max(_rows_per_task(dealt)) <= 1_100
    assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()


def test_few_rows_are_not_moved(spark):
    assert "Exchange" not in plan_of(derived.spread(spark.range(10)))


def test_payments_of_a_large_row_group_are_spread(spark, sf, monkeypatch):
    monkeypatch.setattr(derived.spread, "__defaults__", (100,))
    assert max(_rows_per_task(derived.payment_events(spark, sf))) <= 150


def test_runs_of_a_store_share_one_scoring(spark, sf, monkeypatch):
    plans = []
    monkeypatch.setattr(queries, "fan_out", lambda scored, *_, **__: plans.append(plan_of(scored)))
    queries._store_of_runs(spark, sf)
    assert len(plans) == 3
    assert all("InMemoryTableScan" in plan for plan in plans)


def test_buckets_grow_with_the_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(queries, "_BUCKETED", {})
    asked = []
    monkeypatch.setattr(queries.bucketed, "write_bucketed", lambda rows, *_, buckets: asked.append((rows.count(), buckets)))
    queries._bucketed(spark, sf)
    assert len({buckets for _, buckets in asked}) == 1
    assert all(rows <= 20 * buckets for rows, buckets in asked)


def test_damaged_rows_keep_the_days_of_their_files(spark, sf, monkeypatch):
    hints = []
    write = queries.TableStore._overwrite
    monkeypatch.setattr(
        queries.TableStore, "_overwrite", lambda self, table, rows, *by: (hints.append(plan_of(rows)), write(self, table, rows, *by))
    )
    store = queries._damaged_store(spark, sf)
    assert not any("REBALANCE" in plan.upper() for plan in hints)
    days = store.partitions("transactions").filter(F.to_date("processed_at") != F.col("day"))
    assert days.isEmpty()


def test_a_message_file_is_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 50)
    text = spark.read.text(queries._message_folder(spark, sf)).select("value", F.input_file_name().alias("file"))
    counts = [row["count"] for row in text.groupBy("file").count().collect()]
    assert len(counts) > 4 and max(counts) <= 60
    assert queries._files(spark, sf, 2) > 2 and queries._per_batch(spark, sf) <= queries.FILES_PER_BATCH
