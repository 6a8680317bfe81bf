"""Quality checks with planted defects, and repair of missing alerts."""

from datetime import datetime

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from checks import queries
from riskstream.operators import quality, repair
from riskstream.schemas import FRAUD_ALERTS, TRANSACTIONS
from checks import derived
from riskstream.sources.tables import TableStore

STAMP = datetime(2024, 2, 1)

# Issue counts of the planted defects at scale 0.01, in report order.
PLANTED = [49, 106, 170, 123, 129, 136, 143, 100, 147, 162, 166, 186, 209, 230, 247, 274, 34, 313]


def counts(report):
    return [(r.check_name, r.issue_count) for r in report.collect()]


def test_planted_defects_are_all_counted(spark):
    folder = TESTDATA / "sf0.01"
    if not folder.exists():
        pytest.skip("test tables not present")
    report = queries.REGISTRY["q19_quality_report"](spark, str(folder))
    assert counts(report) == list(zip(quality.CHECKS, PLANTED))


def test_sound_output_passes_and_the_gate_lets_it_through(spark, sf):
    tx, alerts = queries.transactions(spark, sf), queries.fraud_alerts(spark, sf)
    report = quality.quality_report(tx, alerts)
    assert all(n == 0 for _, n in counts(report))
    quality.enforce(report)


def test_gate_names_the_failed_checks(spark, sf):
    report = queries.REGISTRY["q19_quality_report"](spark, sf)
    with pytest.raises(quality.QualityGateError, match="missing_user_id="):
        quality.enforce(report)


def test_empty_tables_pass(spark):
    tx, alerts = spark.createDataFrame([], TRANSACTIONS), spark.createDataFrame([], FRAUD_ALERTS)
    assert counts(quality.quality_report(tx, alerts)) == [(name, 0) for name in quality.CHECKS]


def test_row_checks_move_no_rows(spark, sf):
    plan = quality.row_checks(queries.transactions(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def test_repair_appends_once_and_reports_what_it_wrote(spark, sf, tmp_path):
    store = TableStore(spark, str(tmp_path))
    tx = queries.transactions(spark, sf)
    store.write_run("batch-0", {"transactions": tx, "fraud_alerts": derived.lossy_alerts(tx)})
    before = store.read("fraud_alerts").count()
    report = repair.repair(store, "one", stamp())
    repaired = report.count()
    assert repaired > 0
    assert {r.repaired_count_total for r in report.collect()} == {repaired}
    assert store.read("fraud_alerts").count() == before + repaired
    listed = [r.processed_at for r in report.collect()]
    assert listed == sorted(listed, reverse=True)
    # The same run again replaces itself; another run finds nothing.
    repair.repair(store, "one", stamp())
    assert store.read("fraud_alerts").count() == before + repaired
    again = repair.repair(store, "two", stamp()).collect()
    assert [(r.status, r.repaired_count, r.checked_at) for r in again] == [("NO_MISSING_ALERTS", 0, STAMP)]
    assert store.read("fraud_alerts").count() == before + repaired


def test_report_survives_the_append(spark, sf, tmp_path):
    """The report is evaluated after the append; it must not look at the tables again."""
    store = TableStore(spark, str(tmp_path))
    store.write_run("batch-0", {"transactions": queries.transactions(spark, sf)})
    report = repair.repair(store, "one", stamp())
    alertable = queries.transactions(spark, sf).filter("transaction_status <> 'NORMAL'").count()
    assert report.count() == alertable
