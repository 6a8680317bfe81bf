"""Report contents, CSV sinks, plan shapes and command-line jobs."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from checks import derived, queries
from riskstream import jobs
from riskstream.plans import daily, dashboard, evaluation, snapshot
from riskstream.schemas import TRANSACTIONS
from riskstream.sinks import reports
from riskstream.sources.labelled import labelled_csv, replay_source
from riskstream.sources.tables import TableStore

AT = datetime(2024, 2, 1, 3, 4, 5)


@pytest.fixture(scope="module")
def tx(spark, sf):
    return queries.transactions(spark, sf)


def test_empty_table_gives_zeros(spark):
    empty = spark.createDataFrame([], TRANSACTIONS)
    assert all(float(v) == 0.0 for v in daily.daily_summary(empty).first())
    metrics = evaluation.confusion_metrics(empty).drop("evaluated_at").first()
    assert list(metrics) == [0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0]
    assert daily.status_breakdown(empty).count() == 0
    assert dashboard.final_score_histogram(empty).count() == 0


def test_published_confusion_ratios(spark):
    """168 / 38 / 521 / 0 gives 0.8155, 1.0, 0.8984, 0.9477."""
    cells = [(1, "FRAUD", 168), (0, "SUSPICIOUS", 38), (0, "NORMAL", 521), (None, "FRAUD", 9)]
    rows = [(label, status) for label, status, times in cells for _ in range(times)]
    frame = spark.createDataFrame(rows, "actual_label int, transaction_status string")
    assert list(evaluation.confusion_metrics(frame).drop("evaluated_at").first()) == [168, 38, 521, 0, 0.8155, 1.0, 0.8984, 0.9477]


def test_histograms_keep_every_row(tx):
    for histogram in (dashboard.final_score_histogram(tx), dashboard.probability_histogram(tx)):
        rows = histogram.collect()
        assert sum(r["count"] for r in rows) == 1000
        assert all(0 <= r["bin"] < 20 for r in rows)


def test_histogram_ends(spark):
    frame = spark.createDataFrame([(0, "1.0000"), (100, "0.0500"), (4, "0.0499")], "final_score int, p string")
    frame = frame.selectExpr("final_score", "cast(p as decimal(6,4)) ml_probability", "'FRAUD' transaction_status")
    assert [(r["bin"], r["count"]) for r in dashboard.final_score_histogram(frame).collect()] == [(0, 2), (19, 1)]
    assert [(r["bin"], r["count"]) for r in dashboard.probability_histogram(frame).collect()] == [(0, 1), (1, 1), (19, 1)]


def test_scans_are_pruned_and_filtered(tx):
    plan = plan_of(daily.top_alert_countries(tx)).split("== Physical Plan ==")[1]
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PushedFilters: [In(transaction_status, [FRAUD,SUSPICIOUS])" in scan
    assert "device_id" not in scan and "ml_probability" not in scan
    assert "TakeOrderedAndProject" in plan
    assert "Exchange" not in plan_of(dashboard.latest_transactions(tx)).split("== Physical Plan ==")[1]


def test_reports_stay_on_the_jvm(tx):
    for plan in queries.TRANSACTION_PLANS.values():
        physical = plan_of(plan(tx))
        assert "Python" not in physical and "Pandas" not in physical


def test_csv_names_and_sizes(spark, tx, tmp_path):
    paths = jobs.write_daily_report(tx, str(tmp_path), AT)
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(f"{n}_2024-02-01_03-04-05" for n in paths)
    for name in ("fraud_summary", "fraud_status_distribution", "fraud_top_countries"):
        assert len(list((tmp_path / f"{name}_2024-02-01_03-04-05").glob("part-*.csv"))) == 1
    summary = spark.read.option("header", True).csv(paths["fraud_summary"]).first()
    assert summary.total_transactions == "1000"


def test_sorted_listing_is_sorted_across_part_files(spark, tx, tmp_path):
    path = reports.write_csv(daily.alert_details(tx), str(tmp_path), "fraud_details", AT, small=False)
    parts = sorted((tmp_path / "fraud_details_2024-02-01_03-04-05").glob("part-*.csv"))
    times = [line.split(",")[-1] for part in parts for line in part.read_text().splitlines()[1:]]
    assert times == sorted(times, reverse=True) and len(times) == spark.read.option("header", True).csv(path).count()


def test_labelled_csv_ignores_column_order_and_extra_columns(spark, sf, tmp_path):
    rows = derived.labelled_rows(spark, sf)
    mixed = rows.selectExpr("Class", "'x' AS note", *[c for c in reversed(rows.columns) if c != "Class"])
    path = str(tmp_path / "mixed")
    mixed.write.option("header", True).csv(path)
    back = labelled_csv(spark, path)
    assert back.schema == rows.schema or back.dtypes == rows.dtypes
    assert back.exceptAll(rows).isEmpty() and back.count() == rows.count()


def test_replay_source_checks_its_input(spark, sf, tmp_path):
    rows = derived.labelled_rows(spark, sf)
    rows.filter("Class = 0").write.option("header", True).csv(str(tmp_path / "one"))
    with pytest.raises(ValueError, match="no fraud rows"):
        replay_source(spark, str(tmp_path / "one"))
    rows.drop("Class").write.option("header", True).csv(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="Class"):
        replay_source(spark, str(tmp_path / "none"))


def test_jobs_over_a_store(spark, sf, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.write_run("batch-0", {"transactions": derived.transactions(spark, sf)})
    folder = str(tmp_path / "reports")
    with pytest.raises(ValueError, match="fraud_transaction_without_alert"):
        jobs.check_quality(store, folder, AT)
    jobs.main(["repair", "--store", store.root, "--reports", folder])
    jobs.check_quality(store, folder, datetime(2024, 2, 2))
    jobs.main(["evaluate", "--store", store.root, "--reports", folder])
    jobs.main(["daily", "--store", store.root, "--reports", folder])
    jobs.main(["refresh", "--store", store.root, "--since", "2024-01-01"])
    assert store.read("daily_reports").count() == store.read("transactions").select(F.to_date("transaction_timestamp")).distinct().count()
    jobs.main(["timeline", "--store", store.root, "--checkpoint", str(tmp_path / "cp"), "--once"])
    frauds = store.read("transactions").filter("transaction_status = 'FRAUD'").count()
    assert sum(r.fraud_count for r in store.read("fraud_minutes").collect()) == frauds
    jobs.main(["quality", "--store", store.root, "--reports", folder])
    names = {p.name.rsplit("_", 2)[0] for p in (tmp_path / "reports").iterdir()}
    assert names == {
        "data_quality_report",
        "repair_missing_alerts",
        "model_evaluation_metrics",
        "model_evaluation_distribution",
        "model_top_predictions",
        "fraud_summary",
        "fraud_status_distribution",
        "fraud_details",
        "fraud_top_countries",
    }


def test_snapshot_panels_equal_the_direct_reports(spark, sf):
    """Over damaged rows, so that nulls and odd values are in every dimension."""
    rows = queries.damaged_transactions(spark, sf)
    panels = snapshot.panels(snapshot.kept_cube(rows), ["NORMAL", "FRAUD"])
    direct = {name: plan(rows) for name, plan in snapshot.PANELS.items()}
    direct |= {name: plan(rows, ["NORMAL", "FRAUD"]) for name, plan in snapshot.STATUS_PANELS.items()}
    direct["confusion_metrics"] = evaluation.confusion_metrics(rows)
    assert set(panels) == set(direct)
    for name, expected in direct.items():
        drop = "evaluated_at"
        assert panels[name].dtypes == expected.dtypes, name
        assert panels[name].drop(drop).collect() == expected.drop(drop).collect(), name


def test_snapshot_scans_once(spark, sf):
    plan = plan_of(snapshot.activity_cube(queries.transactions(spark, sf))).split("== Physical Plan ==")[1]
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


def test_snapshot_of_empty_table(spark):
    panels = snapshot.panels(snapshot.kept_cube(spark.createDataFrame([], TRANSACTIONS)))
    assert panels["kpi_block"].first().total_transactions == 0
    assert panels["confusion"].first().true_positives == 0


def test_a_hot_day_is_written_by_several_tasks(spark, sf, tmp_path):
    """Two thirds of the rows fall on one day; its files come from more than one writer."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        store = TableStore(spark, str(tmp_path))
        hot = F.when(F.hash("transaction_id") % 3 == 0, F.col("processed_at")).otherwise(
            F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
        )
        rows = queries.transactions(spark, sf).withColumn("processed_at", hot)
        store.write_run("batch-0", {"transactions": rows.unionByName(rows).unionByName(rows)})
        assert len(list((tmp_path / "transactions").glob("day=2024-01-05/run=batch-0/*.parquet"))) > 1
        assert len(list((tmp_path / "transactions").glob("day=2024-01-06/run=batch-0/*.parquet"))) == 1
        assert store.read("transactions").count() == 3000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(
    "line",
    [
        "score --store s --model m --checkpoint c --messages d --once --batch-files 5",
        "score --store s --model m --checkpoint c --kafka h:1 --topic t --batch-messages 5 --min-partitions 3",
        "train --data d --model m --metrics x",
        "daily --store s --reports r",
        "evaluate --store s --reports r",
        "quality --store s --reports r",
        "repair --store s --reports r",
        "timeline --store s --checkpoint c --lateness 5minutes --once",
        "refresh --store s --since 2024-01-31",
        "averages --store s --checkpoint c --once",
        "score --store s --model m --checkpoint c --messages d --remember 7days",
        "export --store s --jdbc u",
        "publish --data d --kafka h:1",
    ],
)
def test_command_lines(line):
    assert jobs._arguments(line.split()).command == line.split()[0]


def test_the_launcher_runs(spark, sf, tmp_path):
    import subprocess
    import sys

    root = Path(__file__).resolve().parent.parent
    shown = subprocess.run([sys.executable, str(root / "run.py"), "--help"], capture_output=True, text=True, cwd=tmp_path)
    assert shown.returncode == 0 and "timeline" in shown.stdout


def test_scratch_goes_with_its_last_reader(spark, sf):
    """Kept frames leave no files once nothing refers to them, where the session lets Spark clean up."""
    import gc
    import time

    conf = spark.sparkContext._jsc.sc().conf()
    conf.set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    try:
        kept = snapshot.kept_cube(queries.transactions(spark, sf))
        folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
        made = set(folder.glob("rdd-*"))
        assert kept.count() and made
        newest = max(made, key=lambda p: p.stat().st_mtime)
        del kept
        for _ in range(40):
            gc.collect()
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)
            if not newest.exists():
                break
        assert not newest.exists()
    finally:
        conf.set("spark.cleaner.referenceTracking.cleanCheckpoints", "false")
