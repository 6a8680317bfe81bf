"""The scoring stream: equal to batch, restartable, replay-safe, free of duplicates."""

import json
import time
from collections import Counter
from datetime import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from checks import derived, queries
from riskstream.functions.projections import transaction_rows
from riskstream.operators import dedupe, repair
from riskstream.plans import daily
from riskstream.schemas import TRANSACTIONS
from riskstream.sinks.reports import publish_text
from riskstream.sources.messages import file_messages
from riskstream.sources.tables import TableStore
from riskstream.streaming.scoring import BatchWriter, prepared, score_messages, start_rejects, start_scoring
from riskstream.streaming.timeline import fraud_timeline, fraud_windows, start_timeline

TABLES = ("transactions", "risk_scores", "fraud_alerts", "rejected_messages", "batch_quality")


@pytest.fixture(autouse=True, scope="module")
def narrow_state(spark):
    """Few state stores: these streams are small, and each store costs a commit per batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def contents(store, table="transactions"):
    return sorted(map(str, store.read(table).collect()))


@pytest.fixture(scope="module")
def messages(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("messages") / "in")
    publish_text(derived.json_messages(spark, sf).repartition(3), folder)
    return folder


def drain(spark, folder, store, checkpoint, files_per_batch=1, **options):
    writer = BatchWriter(store, derived.probability_from_id, processed_at=stamp())
    streams = [
        start_scoring(
            file_messages(spark, folder, files_per_batch), writer, f"{checkpoint}/scored", availableNow=True, **options
        ),
        start_rejects(file_messages(spark, folder, files_per_batch), store, f"{checkpoint}/rejected", stamp(), availableNow=True),
    ]
    for stream in streams:
        stream.awaitTermination()
    return streams[0]


def message(i, **changes):
    base = {"transaction_id": f"TX-{i}", "user_id": "U1", "amount": 10.0, "timestamp": "2024-01-01 10:00:00"}
    return json.dumps({**base, **changes})


def batch(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def add_file(spark, folder, *texts):
    publish_text(batch(spark, *texts).coalesce(1), str(folder))


def test_stream_equals_batch(spark, messages, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    drain(spark, messages, store, tmp_path / "cp")
    scored = score_messages(spark.read.text(messages), derived.probability_from_id, stamp())
    assert contents(store) == sorted(map(str, transaction_rows(scored).collect()))
    assert store.read("risk_scores").count() == store.read("transactions").count()
    alertable = store.read("transactions").filter("transaction_status <> 'NORMAL'")
    assert store.read("fraud_alerts").count() == alertable.count()
    assert store.read("transactions").count() + store.read("rejected_messages").count() == 1000


def test_restart_reads_nothing_again_and_a_lost_checkpoint_stores_nothing_twice(spark, messages, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    drain(spark, messages, store, tmp_path / "cp")
    before = {table: contents(store, table) for table in TABLES}
    drain(spark, messages, store, tmp_path / "cp")
    assert {table: contents(store, table) for table in TABLES} == before
    # With another checkpoint it is another stream; what the first one stored is dropped.
    drain(spark, messages, store, tmp_path / "lost")
    after = {table: contents(store, table) for table in TABLES}
    assert all(after[table] == before[table] for table in TABLES if table != "rejected_messages")
    assert sum(r.row_count for r in store.read("batch_quality").collect()) == len(before["transactions"])
    assert len(after["rejected_messages"]) == 2 * len(before["rejected_messages"])


def test_two_streams_share_a_store(spark, tmp_path):
    """Both write a batch 0; neither replaces the other's."""
    store = TableStore(spark, str(tmp_path / "store"))
    for name, ids in (("a", (1, 2)), ("b", (2, 3))):
        add_file(spark, tmp_path / name, *map(message, ids))
        drain(spark, str(tmp_path / name), store, tmp_path / f"cp-{name}")
    assert sorted(r.transaction_id for r in store.read("transactions").collect()) == ["TX-1", "TX-2", "TX-3"]
    assert len({r.run for r in store.partitions("transactions").select("run").distinct().collect()}) == 2


def test_duplicates_within_and_across_batches_are_stored_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for texts in ((message(1), message(1), message(2)), (message(2), message(3), message(3)), (message(1), message(4))):
        add_file(spark, tmp_path / "in", *texts)
        drain(spark, str(tmp_path / "in"), store, tmp_path / "cp")
    assert sorted(r.transaction_id for r in store.read("transactions").collect()) == ["TX-1", "TX-2", "TX-3", "TX-4"]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    write = BatchWriter(store, derived.probability_from_id, processed_at=stamp())
    write(prepared(batch(spark, message(1), message(2), message(2), "{bad")), 0)
    write(prepared(batch(spark, message(3))), 1)
    before = {table: contents(store, table) for table in TABLES}
    assert len(before["transactions"]) == 3 and len(before["batch_quality"]) == 2
    write(prepared(batch(spark, message(1), message(2), message(2), "{bad")), 0)
    assert {table: contents(store, table) for table in TABLES} == before
    write(prepared(batch(spark, message(1))), 0)
    assert sorted(r.transaction_id for r in store.read("transactions").collect()) == ["TX-1", "TX-3"]
    assert sum(r.row_count for r in store.read("batch_quality").collect()) == 2


def test_a_batch_is_processed_when_it_arrived_also_when_replayed(spark, tmp_path):
    """The time is that of the batch, as the stream has logged it, so a replay meets the same partitions."""
    store, seen = TableStore(spark, str(tmp_path / "store")), []
    writer = BatchWriter(store, derived.probability_from_id)

    def twice(rows, batch_id):
        for _ in range(2):
            writer(rows, batch_id)
            seen.append(store.read("transactions").select("processed_at").distinct().collect())
            time.sleep(1.1)

    add_file(spark, tmp_path / "in", message(1), message(2))
    stream = prepared(file_messages(spark, str(tmp_path / "in"), 1)).writeStream.foreachBatch(twice)
    stream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 2 and seen[0] == seen[1] and len(seen[0]) == 1


def test_a_stream_of_its_own_reads_no_history(spark, tmp_path, monkeypatch):
    """Batches of one stream: what is stored is never scanned."""
    store = TableStore(spark, str(tmp_path / "store"))
    scanned = []
    whole = store.partitions
    monkeypatch.setattr(store, "partitions", lambda table: scanned.append(table) or whole(table))
    for k in range(4):
        add_file(spark, tmp_path / "in", message(k), message(k + 1))
    drain(spark, str(tmp_path / "in"), store, tmp_path / "cp")
    assert not scanned
    assert store.read("transactions").count() == 5


def state_rows(query):
    return [operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"]]


def test_state_holds_the_ids_of_accepted_messages_and_nothing_else(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    add_file(spark, tmp_path / "in", message(1), message(1), message(2), "{bad", "{bad", "{worse", message(3, amount="x"))
    stream = drain(spark, str(tmp_path / "in"), store, tmp_path / "cp")
    assert state_rows(stream) == [2]
    assert store.read("rejected_messages").count() == 4


def test_ids_are_forgotten_after_the_time_given(spark, tmp_path):
    """With a bound, state rows go once the watermark has passed them; a copy within the time is dropped."""
    store, cp = TableStore(spark, str(tmp_path / "store")), tmp_path / "cp"
    for k in range(3):
        add_file(spark, tmp_path / "in", message(k), message(k), message(k))
        stream = drain(spark, str(tmp_path / "in"), store, cp, within="2 seconds")
        if k == 0:
            add_file(spark, tmp_path / "in", message(0))
            drain(spark, str(tmp_path / "in"), store, cp, within="10 seconds")
        time.sleep(5)
    assert state_rows(stream)[0] <= 2
    assert sorted(r.transaction_id for r in store.read("transactions").collect()) == ["TX-0", "TX-1", "TX-2"]


def test_a_batch_frame_compares_rows_before_it_moves_them(spark):
    rows = spark.range(0, 9000, 1, 9).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id")
    )
    unique = dedupe.drop_repeats(rows)
    assert unique.count() == 6001
    plan = plan_of(unique).split("== Physical Plan ==")[1]
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    BatchWriter(store, derived.probability_from_id)(prepared(batch(spark, message(1)).filter("false")), 0)
    assert not (tmp_path / "store" / "transactions").exists()
    assert store.read("transactions").count() == 0


BAD_NUMBERS = ("NaN", "Infinity", "-Infinity", 1e12, -1e300, 1e308, "text", "", None, True, {"a": 1}, [1])
NUMBERS = ("amount", "user_avg_amount", "amount_vs_avg_user", "actual_label", "Time", "V1", "V28")


def test_no_value_of_a_numeric_field_stops_the_stream(spark, tmp_path):
    texts = [message(100 * i + k, **{name: value}) for i, name in enumerate(NUMBERS) for k, value in enumerate(BAD_NUMBERS)]
    texts += [message(5000 + k).replace("10.0", raw) for k, raw in enumerate(("NaN", "1e400", "-1e400", "Infinity", "0x10"))]
    add_file(spark, tmp_path / "in", *texts)
    store = TableStore(spark, str(tmp_path / "store"))
    drain(spark, str(tmp_path / "in"), store, tmp_path / "cp")
    stored, rejected = store.read("transactions").collect(), store.read("rejected_messages").collect()
    assert len(stored) + len(rejected) == len(texts)
    labels = {r.transaction_id: r.actual_label for r in stored}
    assert labels["TX-300"] is None and labels["TX-303"] is None
    reasons = Counter(r.reject_reason for r in rejected)
    assert reasons["amount_not_a_number"] >= 1 and reasons["amount_out_of_range"] >= 3
    assert {r.body for r in rejected} <= set(texts)


def test_a_crash_between_writes_leaves_no_transaction_without_alert_and_is_healed_by_the_replay(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    write = BatchWriter(store, derived.probability_from_id, processed_at=stamp())
    write(prepared(batch(spark, message(9))), 0)
    texts = prepared(batch(spark, *[message(i, amount=20000.0, merchant_category="Crypto") for i in range(5)]))
    whole = store._overwrite

    def failing(table, rows, *partitions):
        if table == "transactions":
            raise OSError("lost")
        whole(table, rows, *partitions)

    monkeypatch.setattr(store, "_overwrite", failing)
    with pytest.raises(OSError):
        write(texts, 1)
    assert [r.transaction_id for r in store.read("transactions").collect()] == ["TX-9"]
    # a repair that runs now sees no transaction of the open batch, and adds no alert for one
    monkeypatch.setattr(store, "_overwrite", whole)
    repair.repair(store, "meanwhile", stamp())
    write(texts, 1)
    assert store.read("transactions").count() == 6 and store.read("fraud_alerts").count() == 5


# ---------------------------------------------------------------- timeline


def stored(spark, *rows):
    """Stored transactions of (id, status, time)."""
    frame = spark.createDataFrame(rows, "transaction_id string, transaction_status string, at string")
    times = {name: F.col("at").cast("timestamp_ntz") for name in ("transaction_timestamp", "processed_at")}
    known = {"transaction_id", "transaction_status", *times}
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in TRANSACTIONS if f.name not in known]
    return frame.withColumns(times).select(*known, *nulls)


def follow(store, checkpoint, lateness="10 minutes"):
    stream = start_timeline(store.stream("transactions"), store, str(checkpoint), lateness, availableNow=True)
    stream.awaitTermination()
    return {r.minute.strftime("%H:%M"): r.fraud_count for r in fraud_timeline(store).collect()}


def test_timeline_counts_late_events_within_the_watermark_and_replays_once(spark, tmp_path):
    store, cp = TableStore(spark, str(tmp_path / "store")), tmp_path / "cp"
    first = [("a", "FRAUD", "2024-01-01 10:00:05"), ("b", "FRAUD", "2024-01-01 10:00:59"), ("c", "NORMAL", "2024-01-01 10:00:30")]
    store.write_run("s-0", {"transactions": stored(spark, *first)})
    assert follow(store, cp) == {"10:00": 2}
    store.write_run("s-1", {"transactions": stored(spark, ("d", "FRAUD", "2024-01-01 10:05:00"), ("e", "FRAUD", "2024-01-01 10:00:10"))})
    assert follow(store, cp) == {"10:00": 3, "10:05": 1}  # five minutes late: in time
    store.write_run("s-1", {"transactions": stored(spark, ("d", "FRAUD", "2024-01-01 10:05:00"), ("e", "FRAUD", "2024-01-01 10:00:10"))})
    assert follow(store, cp) == {"10:00": 3, "10:05": 1}  # replayed: counted once
    store.write_run("s-2", {"transactions": stored(spark, ("f", "FRAUD", "2024-01-01 10:30:00"))})
    assert follow(store, cp)["10:30"] == 1
    store.write_run("s-3", {"transactions": stored(spark, ("g", "FRAUD", "2024-01-01 10:01:00"), ("h", "FRAUD", "2024-01-01 10:25:00"))})
    assert follow(store, cp) == {"10:00": 3, "10:05": 1, "10:25": 1, "10:30": 1}  # g is past the watermark


def test_timeline_state_falls_behind_the_watermark(spark, tmp_path):
    store, cp = TableStore(spark, str(tmp_path / "store")), tmp_path / "cp"
    for hour in (10, 11, 12, 13):
        rows = [(f"{hour}-{k}", "FRAUD", f"2024-01-01 {hour}:{k:02d}:00") for k in range(20)]
        store.write_run(f"s-{hour}", {"transactions": stored(spark, *rows)})
        stream = start_timeline(store.stream("transactions"), store, str(cp), availableNow=True)
        stream.awaitTermination()
    assert all(rows <= 40 for rows in state_rows(stream))
    assert fraud_timeline(store).count() == 80


def test_timeline_equals_the_batch_report(spark, sf, tmp_path):
    expected = sorted(map(str, queries.REGISTRY["a16_frauds_per_minute"](spark, sf).collect()))
    for name in ("t02_fraud_timeline", "t02_replayed_timeline"):
        assert sorted(map(str, queries.REGISTRY[name](spark, sf).collect())) == expected
    assert sorted(map(str, fraud_windows(queries.transactions(spark, sf)).collect())) == expected
    assert fraud_timeline(TableStore(spark, str(tmp_path))).count() == 0


# ---------------------------------------------------------------- tables


@pytest.fixture(scope="module")
def many_runs(spark, sf, tmp_path_factory):
    """Twelve runs of two owners over three days."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("runs")))
    rows = queries.transactions(spark, sf).withColumn("n", derived.number_of())
    for k in range(12):
        part = rows.filter(F.col("n") % 12 == k).withColumn(
            "processed_at", F.lit(f"2024-02-{1 + k // 4:02d} 00:00:{k:02d}").cast("timestamp_ntz")
        )
        store.write_run(f"own{k % 2}-{k}", {"transactions": part.drop("n")}, one_day=True)
    return store


def files_of(rows):
    return {r.path for r in rows.select(F.input_file_name().alias("path")).distinct().collect()}


def days_read(rows):
    return {path.split("day=")[1][:10] for path in files_of(rows)}


def test_newest_rows_come_from_pruned_days(many_runs, spark):
    order = [F.col("processed_at").desc(), "transaction_id"]
    for top in (1, 30, 84, 500, 5000):
        chosen = many_runs.newest("transactions", top)
        expected = many_runs.read("transactions").orderBy(*order).limit(top).collect()
        assert chosen.orderBy(*order).limit(top).collect() == expected
    listing = many_runs.newest("transactions", 30).orderBy(*order).limit(30)
    plan = plan_of(listing)
    assert "TakeOrderedAndProject" in plan and "PartitionFilters: [isnotnull(day" in plan
    assert days_read(many_runs.newest("transactions", 30)) == {"2024-02-03"}
    assert len(days_read(many_runs.newest("transactions", 500))) == 2


def test_runs_are_read_and_left_out_by_partition(many_runs, spark):
    one = many_runs.read("transactions", run_id="own1-3")
    assert {r.n % 12 for r in one.select(derived.number_of().alias("n")).collect()} == {3}
    others = many_runs.read("transactions", other_than="own1")
    assert {r.n % 2 for r in others.select(derived.number_of().alias("n")).collect()} == {0}
    assert "PartitionFilters: [isnotnull(run" in plan_of(one)


def test_a_replayed_run_replaces_its_own_partitions_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    day = [("a", "FRAUD", "2024-01-01 10:00:00"), ("b", "FRAUD", "2024-01-02 10:00:00")]
    store.write_run("x-0", {"transactions": stored(spark, *day)})
    store.write_run("x-1", {"transactions": stored(spark, ("c", "FRAUD", "2024-01-01 11:00:00"))})
    untouched = files_of(store.read("transactions", run_id="x-1"))
    store.write_run("x-0", {"transactions": stored(spark, ("a", "NORMAL", "2024-01-01 10:00:00"), day[1])})
    found = sorted((r.transaction_id, r.transaction_status) for r in store.read("transactions").collect())
    assert found == [("a", "NORMAL"), ("b", "FRAUD"), ("c", "FRAUD")]
    assert untouched == files_of(store.read("transactions", run_id="x-1"))


def test_refreshed_reports_rewrite_the_dates_touched(spark, sf, tmp_path):
    store, rows = TableStore(spark, str(tmp_path)), queries.transactions(spark, sf)
    late = F.dayofmonth("transaction_timestamp").isin(3, 9) & (derived.number_of() % 2 == 0)
    store.write_run("a-0", {"transactions": rows.filter(~late)})
    daily.refresh_reports(store, store.read("transactions"))
    files = set(store.read("daily_reports").inputFiles())
    store.write_run("a-1", {"transactions": rows.filter(late)})
    daily.refresh_reports(store, store.read("transactions", run_id="a-1"))
    again = set(store.read("daily_reports").inputFiles())
    assert {f.split("day=")[1][:10] for f in again - files} == {"2024-01-03", "2024-01-09"}
    assert sorted(map(str, store.read("daily_reports").collect())) == sorted(map(str, daily.daily_rollup(rows).collect()))
    daily.refresh_reports(store, store.read("transactions", run_id="none"))
    assert set(store.read("daily_reports").inputFiles()) == again


def test_upsert_keeps_one_row_per_key(spark, tmp_path):
    store, kind = TableStore(spark, str(tmp_path)), "minute timestamp_ntz, fraud_count long"
    for counts in ([(1, 5), (2, 6)], [(2, 7), (3, 8)], []):
        store.upsert("fraud_minutes", spark.createDataFrame([(datetime(2024, 1, 1, 0, m), c) for m, c in counts], kind), ["minute"])
    assert {r.minute.minute: r.fraud_count for r in store.read("fraud_minutes").collect()} == {1: 5, 2: 7, 3: 8}


def test_observed_checks_equal_the_report_and_scan_nothing(spark, sf):
    found = {r.check_name: r.issue_count for r in queries.REGISTRY["q20_observed_checks"](spark, sf).collect()}
    report = {r.check_name: r.issue_count for r in queries.REGISTRY["q19_quality_report"](spark, sf).collect()}
    assert len(found) == 15 and found.items() <= report.items()
    read = queries.REGISTRY["q20_observed_checks"](spark, sf).inputFiles()
    assert read and all("/batch_quality/" in f for f in read)
