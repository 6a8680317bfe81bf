"""One registered query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import derived
from riskstream.functions import cleaning, decision, projections, rules
from riskstream.functions import predicates as where
from riskstream.jobs import write_daily_report, write_evaluation_report
from riskstream.operators import quality, rebalance, reconcile, repair, users
from riskstream.operators.dedupe import drop_stored, keep_first
from riskstream.operators.enrich import with_profile, with_running_average
from riskstream.plans import daily, dashboard, evaluation, metrics, training, verification
from riskstream.plans.snapshot import kept_cube, panels
from riskstream.schemas import LABEL, MODEL_FEATURES, SIGNAL_FIELDS
from riskstream.session import workspace
from riskstream.sinks import reports
from riskstream.sources import bucketed
from riskstream.sources.labelled import complete_rows, labelled_csv, replay_source
from riskstream.sources.messages import file_messages
from riskstream.sources.models import load_pipeline, model_inputs, pipeline_scorer
from riskstream.sources.tables import TableStore
from riskstream.streaming.averages import start_averages
from riskstream.streaming.scoring import BatchWriter, fan_out, prepared, start_rejects, start_scoring
from riskstream.streaming.timeline import fraud_timeline, start_timeline

Query = Callable[[SparkSession, str], DataFrame]

STAMP_AT = datetime(2024, 2, 1)
# Messages in one file, which one task writes, and files in one batch of a stream.
ROWS_PER_FILE, FILES_PER_BATCH = 500_000, 8
# Rows of one bucket, which one task sorts.
ROWS_PER_BUCKET = 500_000
REGISTRY: dict[str, Query] = {}


def _stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def query(name: str):
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def _over(source, plan) -> Query:
    return lambda spark, sf: plan(source(spark, sf))


def _over_both(source, other, plan) -> Query:
    return lambda spark, sf: plan(source(spark, sf), other(spark, sf))


# ---------------------------------------------------------------- scratch stores and streams


def _batch_store(spark: SparkSession, sf: str) -> TableStore:
    """A store holding every payment, written as one run."""
    store = TableStore(spark, workspace(spark, "store"))
    scored = derived.scored_events(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    fan_out(scored, store, "batch-0", fixed_point_messages=True)
    scored.unpersist()
    return store


_STORES: dict[tuple[str, str, str], TableStore] = {}


def _store_once(kind: str, build) -> Query:
    """A store is written once per application and data folder; reports read it from there."""

    def stored(spark, sf) -> TableStore:
        key = (spark.sparkContext.applicationId, sf, kind)
        if key not in _STORES:
            _STORES[key] = build(spark, sf)
        return _STORES[key]

    return stored


def _store_with_losses(spark: SparkSession, sf: str) -> TableStore:
    store, tx = TableStore(spark, workspace(spark, "store")), transactions(spark, sf)
    store.write_run("batch-0", {"fraud_alerts": derived.lossy_alerts(tx), "transactions": tx})
    return store


def _damaged_store(spark: SparkSession, sf: str) -> TableStore:
    """The rows come from files of one day each and keep their day, so they stay where they are."""
    store, tx = TableStore(spark, workspace(spark, "store")), transactions(spark, sf)
    tables = {"fraud_alerts": derived.lossy_alerts(tx), "transactions": derived.damaged(tx)}
    quality.write_checked(store, "batch-0", tables, one_day=True)
    return store


def _table(store: Query, name: str) -> Query:
    return lambda spark, sf: store(spark, sf).read(name)


_sound_store = _store_once("sound", _batch_store)
_lossy_store = _store_once("lossy", _store_with_losses)
_damage_store = _store_once("damaged", _damaged_store)

transactions = _table(_sound_store, "transactions")
fraud_alerts = _table(_sound_store, "fraud_alerts")
lossy_alerts = _table(_lossy_store, "fraud_alerts")
damaged_transactions = _table(_damage_store, "transactions")
damaged_alerts = _table(_damage_store, "fraud_alerts")


def _files(spark: SparkSession, sf: str, least: int) -> int:
    """How many files the messages of all payments take: ``least``, or more when one file would be too much for one task."""
    return max(least, -(-derived.input_table(spark, sf, "events").count() // ROWS_PER_FILE))


def _message_folder(spark: SparkSession, sf: str) -> str:
    """The messages as text files, several of them so that a stream takes several batches."""
    folder = workspace(spark, "messages")
    reports.publish_text(derived.json_messages(spark, sf).repartition(_files(spark, sf, 4)), folder)
    return folder


def _per_batch(spark: SparkSession, sf: str) -> int:
    """Files a batch: half of the files of a folder, up to ``FILES_PER_BATCH``, so that a batch stays within bounds."""
    return min(FILES_PER_BATCH, -(-_files(spark, sf, 4) // 2))


def _writer(store: TableStore) -> BatchWriter:
    return BatchWriter(store, derived.probability_from_id, processed_at=_stamp(), fixed_point_messages=True)


def _drain(
    spark: SparkSession, folder: str, store: TableStore, checkpoint: str, files_per_batch: int = 2, within: str | None = None
) -> None:
    messages = file_messages(spark, folder, files_per_batch)
    start_scoring(messages, _writer(store), f"{checkpoint}/scored", within, availableNow=True).awaitTermination()


def _streamed_store(spark: SparkSession, sf: str) -> TableStore:
    store = TableStore(spark, workspace(spark, "store"))
    _drain(spark, _message_folder(spark, sf), store, workspace(spark, "checkpoint"), _per_batch(spark, sf))
    return store


def _stored_counts(store: TableStore) -> DataFrame:
    return verification.table_counts(
        **{name: store.read(name) for name in ("transactions", "risk_scores", "fraud_alerts")}
    )


def _tx_and_alerts(plan) -> Query:
    return _over_both(damaged_transactions, damaged_alerts, plan)


# ---------------------------------------------------------------- sources


@query("s01_message_stream")
def message_stream(spark, sf):
    seen = workspace(spark, "seen")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")

    stream = file_messages(spark, _message_folder(spark, sf), _per_batch(spark, sf)).writeStream.foreachBatch(keep)
    stream.option("checkpointLocation", workspace(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("value string").parquet(f"{seen}/batch=*").agg(F.count(F.lit(1)).alias("message_count"))


def _labelled_file(spark, sf) -> str:
    path = workspace(spark, "labelled")
    derived.labelled_rows(spark, sf).write.option("header", True).csv(path)
    return path


@query("s02_labelled_csv")
def labelled_scan(spark, sf):
    return labelled_csv(spark, _labelled_file(spark, sf))


@query("s03_replay_source")
def replay(spark, sf):
    normal, fraud = replay_source(spark, _labelled_file(spark, sf))
    parts = normal.withColumn("part", F.lit("normal")).unionByName(fraud.withColumn("part", F.lit("fraud")))
    return parts.select("part", "Time", "Amount")


REGISTRY["s04_transactions_scan"] = transactions
REGISTRY["s05_alerts_scan"] = fraud_alerts


# ---------------------------------------------------------------- sinks


@query("k01_fan_out")
def fan_out_counts(spark, sf):
    return _stored_counts(_streamed_store(spark, sf))


@query("k02_empty_batch")
def empty_batch(spark, sf):
    store = TableStore(spark, workspace(spark, "store"))
    write = _writer(store)
    messages = spark.read.text(_message_folder(spark, sf))
    write(prepared(messages), 0)
    write(prepared(messages.filter(F.lit(False))), 1)
    runs = store.partitions("transactions").groupBy(F.col("run").alias("run_id"))
    return runs.agg(F.count(F.lit(1)).alias("row_count"))


REGISTRY["k03_append_transactions"] = _table(_batch_store, "transactions")


@query("k03_two_streams")
def two_streams(spark, sf):
    """Two streams with checkpoints of their own fill one store, each from half of the messages."""
    store = TableStore(spark, workspace(spark, "store"))
    messages = derived.json_messages(spark, sf)
    for rest in (0, 1):
        folder = workspace(spark, "messages")
        half = messages.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == rest)
        reports.publish_text(half.repartition(_files(spark, sf, 2)), folder)
        _drain(spark, folder, store, workspace(spark, "checkpoint"), _per_batch(spark, sf))
    return store.read("transactions")


@query("k03_replayed_run")
def replayed_run(spark, sf):
    """Two runs, the second first with half of its rows, then again with all: it replaces its own partitions."""
    store, scored = TableStore(spark, workspace(spark, "store")), derived.scored_events(spark, sf)
    for run, rows in (("a-0", "n % 2 = 0"), ("a-1", "n % 4 = 1"), ("a-1", "n % 2 = 1")):
        store.write_run(run, {"transactions": projections.transaction_rows(scored.filter(rows))})
    return store.read("transactions")


@query("k03_rejected_messages")
def rejected_stream(spark, sf):
    """Messages that cannot be scored, stored by a stream of their own; by reason."""
    store = TableStore(spark, workspace(spark, "store"))
    messages = file_messages(spark, _message_folder(spark, sf), _per_batch(spark, sf))
    checkpoint = workspace(spark, "checkpoint")
    start_rejects(messages, store, checkpoint, _stamp(), availableNow=True).awaitTermination()
    return store.read("rejected_messages").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


REGISTRY["k04_append_risk_scores"] = _table(_batch_store, "risk_scores")
REGISTRY["k05_append_alerts"] = _table(_batch_store, "fraud_alerts")


@query("k06_append_repairs")
def append_repairs(spark, sf):
    store = _store_with_losses(spark, sf)
    repair.repair(store, "nightly", _stamp())
    return store.read("fraud_alerts")


def _csv_counts(spark, paths: dict[str, str]) -> DataFrame:
    back = {name: spark.read.option("header", True).csv(path) for name, path in paths.items()}
    return verification.table_counts(**back).withColumnRenamed("table_name", "report")


@query("k07_daily_csv")
def daily_csv(spark, sf):
    return _csv_counts(spark, write_daily_report(transactions(spark, sf), workspace(spark, "reports"), STAMP_AT))


@query("k08_quality_csv")
def quality_csv(spark, sf):
    report = REGISTRY["q19_quality_report"](spark, sf)
    path = reports.write_csv(report, workspace(spark, "reports"), "data_quality_report", STAMP_AT)
    declared = "check_name string, status string, issue_count bigint, checked_at timestamp_ntz"
    return spark.read.option("header", True).schema(declared).csv(path).drop("checked_at")


@query("k09_evaluation_csv")
def evaluation_csv(spark, sf):
    return _csv_counts(spark, write_evaluation_report(transactions(spark, sf), workspace(spark, "reports"), STAMP_AT))


def _csv_content(write, plan, report: str) -> Query:
    """A report read back from its file, with the types it was written from."""

    def read(spark, sf) -> DataFrame:
        tx = transactions(spark, sf)
        path = write(tx, workspace(spark, "reports"), STAMP_AT)[report]
        return spark.read.options(**reports.CSV_OPTIONS).schema(plan(tx).schema).csv(path)

    return read


#: Written report -> the query that states its content.
CSV_CONTENTS = {
    "k07_fraud_summary": "a01_daily_summary",
    "k07_fraud_status_distribution": "a02_status_breakdown",
    "k07_fraud_top_countries": "a03_top_alert_countries",
    "k07_fraud_details": "l01_alert_details",
    "k09_model_evaluation_distribution": "a13_label_status_breakdown",
    "k09_model_top_predictions": "l02_top_predictions",
}


@query("k09_model_evaluation_metrics")
def evaluation_metrics_csv(spark, sf):
    content = _csv_content(write_evaluation_report, evaluation.confusion_metrics, "model_evaluation_metrics")
    return content(spark, sf).drop("evaluated_at")


@query("k10_repair_csv")
def repair_csv(spark, sf):
    report = repair.repair(_store_with_losses(spark, sf), "nightly", _stamp())
    path = reports.write_csv(report, workspace(spark, "reports"), "repair_missing_alerts", STAMP_AT, small=False)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        "transaction_id",
        F.col("risk_score").cast("int").alias("risk_score"),
        "repair_status",
        F.col("repaired_count_total").cast("bigint").alias("repaired_count_total"),
    )


@query("k13_publish_messages")
def publish(spark, sf):
    events = derived.events_with_signals(spark, sf).drop("n")
    timed = events.withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).drop("event_time")
    messages = reports.keyed_messages(timed)
    keyed = messages.select("key", F.from_json("value", "transaction_id string").alias("named"))
    folder = workspace(spark, "published")
    reports.publish_text(messages, folder)
    keys = keyed.select(F.col("key").alias("message_key"), F.col("named.transaction_id").alias("transaction_id"))
    back = cleaning.parse_events(cleaning.message_text(spark.read.text(folder)))
    return back.join(keys, "transaction_id").select(
        "message_key",
        *[c for c in back.columns if c != "transaction_id"],
        "transaction_id",
    )


# ---------------------------------------------------------------- parsing and cleaning


def _bodies(spark, sf) -> DataFrame:
    raw = derived.json_messages(spark, sf).select(F.encode("value", "UTF-8").alias("value"))
    return cleaning.message_text(raw)


def _parsed(spark, sf) -> DataFrame:
    return cleaning.parse_events(_bodies(spark, sf))


@query("p01_message_text")
def text(spark, sf):
    return _bodies(spark, sf).select(F.get_json_object("body", "$.device_id").alias("device_id"))


@query("p02_json_to_struct")
def json_to_struct(spark, sf):
    return _parsed(spark, sf)


@query("p03_flatten_event")
def flatten(spark, sf):
    return _parsed(spark, sf)


@query("p04_event_time")
def parse_time(spark, sf):
    return cleaning.with_event_time(_parsed(spark, sf)).select("transaction_id", "timestamp", "event_time")


@query("p05_default_average")
def default_average(spark, sf):
    return cleaning.with_spend_defaults(_parsed(spark, sf)).select("transaction_id", "user_avg_amount")


@query("p06_default_ratio")
def default_ratio(spark, sf):
    return cleaning.with_spend_defaults(_parsed(spark, sf)).select("transaction_id", "amount_vs_avg_user")


@query("p07_fill_features")
def fill(spark, sf):
    filled = cleaning.fill_features(derived.events_with_signals(spark, sf))
    return filled.select("n", "transaction_id", "amount", "Time", *SIGNAL_FIELDS)


@query("p08_model_amount")
def model_amount(spark, sf):
    """The model's ``Amount`` beside the event's ``amount``, as the scorer packs them."""
    events = cleaning.fill_features(derived.events_with_signals(spark, sf))
    return model_inputs(events).select("event.transaction_id", "event.amount", F.col("Amount").alias("model_amount"))


def _scored_messages(spark, sf) -> DataFrame:
    events = cleaning.accepted_events(_bodies(spark, sf))
    return decision.with_decision(derived.probability_from_id(rules.with_rule_scores(events)), _stamp())


REGISTRY["p09_transaction_rows"] = _over(_scored_messages, projections.transaction_rows)
REGISTRY["p10_risk_score_rows"] = _over(_scored_messages, projections.risk_score_rows)


@query("p11_alert_rows")
def alert_projection(spark, sf):
    """Alerts with the raw probability in the message, cut in two at its start: the text before
    it, and the number read back from it."""
    alerts = projections.alert_rows(derived.scored_events(spark, sf))
    mark = "ml_probability="
    return alerts.select(
        "alert_id",
        "transaction_id",
        "user_id",
        "risk_score",
        "alert_type",
        "status",
        F.concat(F.substring_index("message", mark, 1), F.lit(mark)).alias("message_text"),
        F.substring_index("message", mark, -1).cast("double").alias("message_probability"),
    )


@query("p12_complete_rows")
def complete(spark, sf):
    vec_id = F.col("Time").cast("bigint")
    gaps = derived.labelled_rows(spark, sf).withColumns(
        {
            "V3": F.when(vec_id % 7 == 0, None).when(vec_id % 11 == 0, float("nan")).otherwise(F.col("V3")),
            LABEL: F.when(vec_id % 13 != 0, F.col(LABEL)),
        }
    )
    return complete_rows(gaps)


def _missing(spark, sf) -> DataFrame:
    return repair.missing_alerts(transactions(spark, sf), lossy_alerts(spark, sf))


REGISTRY["p13_repair_alert_rows"] = _over(_missing, lambda missing: projections.repair_alert_rows(missing, _stamp()))
REGISTRY["p14_repair_report"] = _over(_missing, lambda missing: repair.repair_report(missing, _stamp()))


@query("p14_repair_report_none")
def nothing_missing(spark, sf):
    missing = repair.missing_alerts(transactions(spark, sf), fraud_alerts(spark, sf))
    return repair.repair_report(missing, _stamp())


@query("p15_profile_enrichment")
def enrichment(spark, sf):
    spend = derived.input_table(spark, sf, "events").select("event_id", "user_id", F.col("value").alias("amount"))
    profiles = derived.user_profiles(spark, sf).withColumnRenamed("user_avg_amount", "avg_amount")
    return with_profile(spend, profiles, spread_by="event_id")


@query("p15_running_average")
def running_average(spark, sf):
    """Every payment against what its user spent before."""
    events = derived.payment_events(spark, sf).drop("user_avg_amount", "amount_vs_avg_user")
    averaged = with_running_average(events)
    return averaged.select("transaction_id", "user_avg_amount", "amount_vs_avg_user")


@query("p15_running_average_stream")
def running_average_stream(spark, sf):
    """The same along a stream: ten days of payments at a time, each drained, one stored twice."""
    store, checkpoint = TableStore(spark, workspace(spark, "store")), workspace(spark, "checkpoint")
    rows = projections.transaction_rows(derived.scored_events(spark, sf))
    day = F.dayofmonth("transaction_timestamp")
    for run, part in (("a-0", day <= 10), ("a-1", (day > 10) & (day <= 20)), ("a-1", (day > 10) & (day <= 20)), ("a-2", day > 20)):
        store.write_run(run, {"transactions": rows.filter(part)})
        start_averages(store.stream("transactions"), store, checkpoint, availableNow=True).awaitTermination()
    return store.read("spend_profiles").select("transaction_id", "user_avg_amount", "amount_vs_avg_user")


# ---------------------------------------------------------------- filters


@query("f01_required_fields")
def required_fields(spark, sf):
    return cleaning.accepted_events(_bodies(spark, sf)).select("transaction_id", "user_id", "amount", "event_time")


@query("f01_rejected_messages")
def rejected(spark, sf):
    reasons = cleaning.rejected_events(_bodies(spark, sf)).groupBy("reject_reason")
    return reasons.agg(F.count(F.lit(1)).alias("row_count"))


def _filtered(source, condition, *columns) -> Query:
    return _over(source, lambda tx: tx.filter(condition()).select(*columns))


REGISTRY["f02_alertable"] = _filtered(
    transactions, where.is_alertable, "transaction_id", "transaction_status"
)
REGISTRY["f03_selected_statuses"] = _filtered(
    transactions, lambda: where.status_in(["NORMAL", "FRAUD"]), "transaction_id", "transaction_status"
)
REGISTRY["f03_no_selection"] = _filtered(
    transactions, lambda: where.status_in([]), "transaction_id", "transaction_status"
)
REGISTRY["f04_labelled"] = _filtered(
    damaged_transactions, where.is_labelled, "transaction_id", "actual_label"
)
REGISTRY["f05_scores_present"] = _filtered(
    damaged_transactions, where.has_scores, "transaction_id", *where.SCORES
)
REGISTRY["f06_fraud_only"] = _filtered(transactions, where.is_fraud, "transaction_id")
REGISTRY["f07_by_class"] = _filtered(derived.labelled_rows, lambda: where.in_class(1), "Time", LABEL)


@query("f08_faulty_rows")
def faulty_rows(spark, sf):
    tx = damaged_transactions(spark, sf)
    found = [F.when(faulty(), name) for name, faulty in quality.ROW_CHECKS.items()]
    checks = F.explode(F.array_compact(F.array(*found))).alias("check_name")
    return tx.select("device_id", "ip_address", checks)


# ---------------------------------------------------------------- scoring


def _ruled(spark, sf) -> DataFrame:
    return rules.with_rule_scores(derived.payment_events(spark, sf))


def _column(source, name: str) -> Query:
    return _over(source, lambda df: df.select("transaction_id", name))


for _number, _name in enumerate([*rules.RULES, "rule_score", "behavior_score"], start=1):
    REGISTRY[f"r{_number:02d}_{_name}"] = _column(_ruled, _name)
for _number, _name in enumerate(
    ("ml_score", "final_score", "transaction_status", "risk_score", "detection_method"), start=10
):
    REGISTRY[f"r{_number:02d}_{_name}"] = _column(derived.scored_events, _name)


@query("r15_processed_at")
def processed_at(spark, sf):
    scored = decision.with_decision(rules.with_rule_scores(derived.payment_events(spark, sf)))
    times = scored.groupBy("processed_at").agg(F.count(F.lit(1)).alias("rows"))
    return times.agg(F.sum("rows").alias("row_count"), F.count(F.lit(1)).cast("int").alias("distinct_times"))


# ---------------------------------------------------------------- learning

_TRAINED: dict[tuple[str, str], training.Training] = {}


def _training(spark, sf) -> training.Training:
    """The model for one data folder; fitted once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        by_row = lambda df: rebalance.hash_split(df, "Time", share=training.TRAINING_SHARE)
        _TRAINED[key] = training.train(derived.labelled_rows(spark, sf), split=by_row)
    return _TRAINED[key]


def _saved_model(spark, sf) -> str:
    path = workspace(spark, "model")
    training.save_pipeline(_training(spark, sf).model, path)
    return path


def _known(predictions: DataFrame) -> DataFrame:
    """Of scored rows what does not depend on what the forest learned."""
    sound = F.col("ml_probability").between(0, 1) & F.col("prediction").isin(0.0, 1.0)
    return predictions.select("row_time", "label", sound.alias("sound"))


@query("s06_model_scan")
def model_scan(spark, sf):
    model = load_pipeline(_saved_model(spark, sf))
    return _known(training.prediction_rows(model.transform(derived.labelled_rows(spark, sf))))


@query("k11_model_save")
def model_save(spark, sf):
    path = _saved_model(spark, sf)
    training.save_pipeline(_training(spark, sf).model, path)
    trees = load_pipeline(path).stages[-1]
    return derived.labelled_rows(spark, sf).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.lit(trees.getNumTrees).alias("trees")
    )


@query("k12_training_record")
def training_record(spark, sf):
    path = workspace(spark, "metrics")
    record = training.metrics_record(spark, _training(spark, sf).metrics)
    reports.write_record(record, path)
    back = spark.read.schema(record.schema).json(path)
    return back.select(
        "model_type",
        "total_rows",
        "normal_rows",
        "fraud_rows",
        (F.col("auc") > 0.9).alias("auc_is_high"),
        (F.col("f1") > 0.9).alias("f1_is_high"),
        F.array_join("features", ",").alias("features"),
    )


def _event_probabilities(spark, sf) -> DataFrame:
    events = cleaning.fill_features(derived.events_with_signals(spark, sf))
    return pipeline_scorer(_training(spark, sf).model)(events)


@query("r09_ml_probability")
def ml_probability(spark, sf):
    return _event_probabilities(spark, sf).select(
        "transaction_id", F.col("ml_probability").between(0, 1).alias("sound")
    )


@query("m01_class_weights")
def class_weights(spark, sf):
    return rebalance.with_class_weight(derived.labelled_rows(spark, sf)).select("Time", LABEL, "class_weight")


@query("m02_hash_split")
def split_by_hash(spark, sf):
    rows = derived.labelled_rows(spark, sf).select(F.col("Time").cast("bigint").alias("row_id"))
    train, held_out = rebalance.hash_split(rows, "row_id", share=0.8)
    return train.withColumn("part", F.lit("train")).unionByName(held_out.withColumn("part", F.lit("held_out")))


@query("m02_random_split")
def split_at_random(spark, sf):
    """Both parts hold every row once, and the larger about its share; which row is where is left to chance."""
    train, held_out = rebalance.random_split(derived.labelled_rows(spark, sf).select("Time"))
    parts = train.withColumn("part", F.lit(1)).unionByName(held_out.withColumn("part", F.lit(0)))
    return parts.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("Time").alias("distinct_rows"),
        F.avg("part").between(0.7, 0.9).alias("share_is_near"),
    )


@query("m03_feature_vector")
def feature_vector(spark, sf):
    assembled = training.assembler().transform(derived.labelled_rows(spark, sf))
    values = vector_to_array("features")
    return assembled.select(
        values[0].alias("first_input"),
        values[1].alias("second_input"),
        values[29].alias("last_input"),
        F.size(values).alias("inputs"),
    )


@query("m04_forest")
def forest_importances(spark, sf):
    trees = _training(spark, sf).model.stages[-1]
    weights = trees.featureImportances.toArray()
    rows = [(name, 0 <= float(weight) <= 1) for name, weight in zip(MODEL_FEATURES, weights, strict=True)]
    return spark.createDataFrame(rows, "feature string, sound boolean")


@query("m05_pipeline_fit")
def pipeline_stages(spark, sf):
    stages = _training(spark, sf).model.stages
    return spark.createDataFrame([(i, type(s).__name__) for i, s in enumerate(stages)], "position int, stage string")


@query("m06_batch_scoring")
def batch_scoring(spark, sf):
    return _known(training.prediction_rows(_training(spark, sf).predictions))


@query("m07_stream_scoring")
def stream_scoring(spark, sf):
    """Every payment published with its model inputs, scored by the forest on the stream."""
    events = derived.events_with_signals(spark, sf)
    timed = events.withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    folder, store = workspace(spark, "messages"), TableStore(spark, workspace(spark, "store"))
    messages = reports.keyed_messages(timed.drop("n", "event_time"))
    reports.publish_text(messages.repartition(_files(spark, sf, 4)), folder)
    scorer = pipeline_scorer(_training(spark, sf).model)
    writer = BatchWriter(store, scorer, processed_at=_stamp())
    files = file_messages(spark, folder, _per_batch(spark, sf))
    start_scoring(files, writer, workspace(spark, "checkpoint"), availableNow=True).awaitTermination()
    # the stored probability is rounded to four digits, so a score made from it may be off by one
    stored = store.read("transactions").withColumn("ml_probability", F.col("ml_probability").cast("double"))
    ruled = store.read("risk_scores").select("transaction_id", sum(map(F.col, rules.RULES)).alias("rule_score"))
    again = decision.with_decision(
        stored.select("transaction_id", "ml_probability", "behavior_score", F.col("final_score").alias("stored_score"))
        .join(ruled, "transaction_id"),
        _stamp(),
    )
    return again.select(
        "transaction_id",
        F.col("ml_probability").between(0, 1).alias("sound"),
        (F.abs(F.col("final_score") - F.col("stored_score")) <= 1).alias("score_follows"),
    )


@query("m08_area_under_roc")
def auc(spark, sf):
    """Of the supplied probability; the tests compare the forest's own with Spark's evaluator."""
    return metrics.area_under_roc(derived.scored_events(spark, sf))


@query("m08_area_under_roc_of_scores")
def auc_of_scores(spark, sf):
    """Of the stored final score, an integer with many ties, on rows with nulls."""
    return metrics.area_under_roc(damaged_transactions(spark, sf), "final_score")


@query("m09_weighted_f1")
def f1(spark, sf):
    found = metrics.weighted_f1(transactions(spark, sf), prediction=where.is_alertable().cast("int"))
    return found.withColumn("f1", F.round("f1", 12))


@query("m09_weighted_f1_of_classes")
def f1_of_classes(spark, sf):
    """Behavior scores as predictions of final scores in tens: classes on either side without a match."""
    tens = F.col("final_score") - F.col("final_score") % 10
    return metrics.weighted_f1(damaged_transactions(spark, sf), tens, "behavior_score").withColumn("f1", F.round("f1", 12))


@query("m10_rebalance")
def rebalanced(spark, sf):
    """All payments, thinned to one fraud in ten."""
    labelled = derived.payment_events(spark, sf).select("n", F.col("actual_label").cast("int").alias(LABEL))
    return rebalance.rebalance(labelled, "n", fraud_share=0.10)


# ---------------------------------------------------------------- joins

REGISTRY["j01_alerts_without_transaction"] = _tx_and_alerts(
    lambda tx, alerts: reconcile.alerts_without_transaction(alerts, tx)
)
REGISTRY["j02_transactions_without_alert"] = _tx_and_alerts(
    lambda tx, alerts: quality.check_count("fraud_transaction_without_alert", tx, alerts)
)
REGISTRY["j03_missing_alerts"] = _missing


@query("j04_repair_insert")
def repair_insert(spark, sf):
    store = _store_with_losses(spark, sf)
    repair.repair(store, "nightly", _stamp())
    return store.read("fraud_alerts", run_id="repair-nightly")


@query("j05_profile_lookup")
def profile_lookup(spark, sf):
    return enrichment(spark, sf).select("event_id", "usual_country", "user_avg_amount")


_BUCKETED: dict[tuple[str, str], tuple[str, str]] = {}


def _bucketed(spark, sf) -> tuple[str, str]:
    """Names of the damaged tables in buckets of the transaction id, written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUCKETED:
        names = tuple(f"{name}_{uuid4().hex}" for name in ("transactions", "fraud_alerts"))
        tables = [table(spark, sf) for table in (damaged_transactions, damaged_alerts)]
        buckets = max(16, -(-max(rows.count() for rows in tables) // ROWS_PER_BUCKET))  # counts of footers
        for name, rows in zip(names, tables, strict=True):
            bucketed.write_bucketed(rows, name, workspace(spark, "bucketed"), buckets=buckets)
        _BUCKETED[key] = names
    return _BUCKETED[key]


@query("j01_alerts_without_transaction_bucketed")
def lonely_alerts_bucketed(spark, sf):
    transactions_name, alerts_name = _bucketed(spark, sf)
    return bucketed.alerts_without_transaction(spark, alerts_name, transactions_name)


@query("j03_missing_alerts_bucketed")
def missing_alerts_bucketed(spark, sf):
    return bucketed.transactions_without_alert(spark, *_bucketed(spark, sf)).select("transaction_id", "user_id", "processed_at")


# ---------------------------------------------------------------- reports

TRANSACTION_PLANS = {
    "a01_daily_summary": daily.daily_summary,
    "a02_status_breakdown": daily.status_breakdown,
    "a03_top_alert_countries": daily.top_alert_countries,
    "a04_kpi_block": lambda tx: dashboard.kpi_block(tx, ["SUSPICIOUS", "FRAUD"]),
    "a05_status_distribution": dashboard.status_distribution,
    "a06_top_countries": dashboard.top_countries,
    "a07_final_score_histogram": dashboard.final_score_histogram,
    "a08_probability_histogram": dashboard.probability_histogram,
    "a09_behavior_distribution": dashboard.behavior_distribution,
    "a10_method_distribution": dashboard.method_distribution,
    "a11_confusion": evaluation.confusion,
    "a12_confusion_metrics": lambda tx: evaluation.confusion_metrics(tx, _stamp()),
    "a13_label_status_breakdown": evaluation.label_status_breakdown,
    "a14_label_status_matrix": evaluation.label_status_matrix,
    "a14_label_status_matrix_wide": lambda tx: evaluation.label_status_matrix(tx, wide=True),
    "a15_label_profile": evaluation.label_profile,
    "a16_frauds_per_minute": dashboard.frauds_per_minute,
    "l01_alert_details": daily.alert_details,
    "l02_top_predictions": evaluation.top_predictions,
    "x01_daily_rollup": daily.daily_rollup,
}
for _name, _plan in TRANSACTION_PLANS.items():
    REGISTRY[_name] = _over(transactions, _plan)
for _name, _content in CSV_CONTENTS.items():
    _write = write_daily_report if _name.startswith("k07") else write_evaluation_report
    REGISTRY[_name] = _csv_content(_write, TRANSACTION_PLANS[_content], _name[4:])

# The same on rows with nulls: labels, scores and methods.
DAMAGED_PLANS = [name for name in TRANSACTION_PLANS if "a07" <= name[:3] <= "a15" and not name.endswith("_wide")]
for _name in DAMAGED_PLANS:
    REGISTRY[f"{_name}_damaged"] = _over(damaged_transactions, TRANSACTION_PLANS[_name])


# The same breakdowns, all from one pass over the transactions.
FROM_CUBE = {
    "a01_daily_summary": "daily_summary",
    "a02_status_breakdown": "status_breakdown",
    "a03_top_alert_countries": "top_alert_countries",
    "a04_kpi_block": "kpi_block",
    "a05_status_distribution": "status_distribution",
    "a06_top_countries": "top_countries",
    "a07_final_score_histogram": "final_score_histogram",
    "a08_probability_histogram": "probability_histogram",
    "a09_behavior_distribution": "behavior_distribution",
    "a10_method_distribution": "method_distribution",
    "a11_confusion": "confusion",
    "a12_confusion_metrics": "confusion_metrics",
    "a13_label_status_breakdown": "label_status_breakdown",
    "a14_label_status_matrix": "label_status_matrix",
    "a15_label_profile": "label_profile",
}
_CUBES: dict[tuple, DataFrame] = {}


def _panel(name: str) -> Query:
    """One breakdown of the cube, which is kept once per application and data folder."""
    statuses = ("SUSPICIOUS", "FRAUD") if name == "kpi_block" else ()

    def read(spark, sf) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf)
        if key not in _CUBES:
            _CUBES[key] = kept_cube(transactions(spark, sf))
        return panels(_CUBES[key], statuses, _stamp())[name]

    return read


for _name, _panel_name in FROM_CUBE.items():
    REGISTRY[f"{_name}_from_cube"] = _panel(_panel_name)


@query("a17_table_counts")
def table_counts(spark, sf):
    return _stored_counts(_batch_store(spark, sf))


REGISTRY["a18_duplicated_ids"] = _over(damaged_transactions, reconcile.duplicated_ids)


def _newest(store: Query, table: str, top: int, plan) -> Query:
    """A listing that reads only the days which hold the newest rows."""
    return lambda spark, sf: plan(store(spark, sf).newest(table, top))


def _store_of_runs(spark: SparkSession, sf: str) -> TableStore:
    """Payments in several runs."""
    store = TableStore(spark, workspace(spark, "store"))
    scored = derived.scored_events(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    for rest in range(3):
        fan_out(scored.filter(F.col("n") % 3 == rest), store, f"batch-{rest}", fixed_point_messages=True)
    scored.unpersist()
    return store


_merged_store = _store_once("merged", _store_of_runs)
for _suffix, _kind in (("", _sound_store), ("_merged", _merged_store)):
    REGISTRY[f"l03_latest_transactions{_suffix}"] = _newest(_kind, "transactions", 30, dashboard.latest_transactions)
    REGISTRY[f"l04_latest_alerts{_suffix}"] = _newest(_kind, "fraud_alerts", 30, dashboard.latest_alerts)
    REGISTRY[f"l05_latest_checked{_suffix}"] = _newest(_kind, "transactions", 20, verification.latest_checked)
REGISTRY["l06_newest_missing_alerts"] = _missing


# ---------------------------------------------------------------- quality


def _single_check(name: str) -> Query:
    return _tx_and_alerts(lambda tx, alerts: quality.check_count(name, tx, alerts))


for _number, _name in enumerate(quality.CHECKS, start=1):
    REGISTRY[f"q{_number:02d}_{_name}"] = _single_check(_name)
REGISTRY["q19_quality_report"] = _tx_and_alerts(lambda tx, alerts: quality.quality_report(tx, alerts, _stamp()))


@query("q20_observed_checks")
def observed_checks(spark, sf):
    """The row checks from the counts taken while the damaged rows were written; they are not read again."""
    return quality.observed_checks(_damage_store(spark, sf).read("batch_quality"))


@query("q19_quality_gate")
def quality_gate(spark, sf):
    report = REGISTRY["q19_quality_report"](spark, sf)
    try:
        quality.enforce(report)
        failed = False
    except quality.QualityGateError:
        failed = True
    return spark.range(1).select(F.lit(failed).alias("gate_failed"))


# ---------------------------------------------------------------- streams


@query("t01_scoring_stream")
def scoring_stream(spark, sf):
    return _streamed_store(spark, sf).read("transactions")


@query("t01_scoring_stream_alerts")
def scoring_stream_alerts(spark, sf):
    return _streamed_store(spark, sf).read("fraud_alerts")


@query("t01_restarted_stream")
def restarted_stream(spark, sf):
    """Drained, then started again from its checkpoint with nothing new, then with the first
    batch replayed by hand; the table must not change."""
    folder, store, checkpoint = _message_folder(spark, sf), TableStore(spark, workspace(spark, "store")), workspace(
        spark, "checkpoint"
    )
    _drain(spark, folder, store, checkpoint, files_per_batch=8)
    _drain(spark, folder, store, checkpoint, files_per_batch=8)
    _writer(store)(prepared(spark.read.text(folder)), 0)
    return store.read("transactions")


def _drain_timeline(store: TableStore, checkpoint: str, lateness: str) -> None:
    stream = start_timeline(store.stream("transactions"), store, checkpoint, lateness, availableNow=True)
    stream.awaitTermination()


def _timeline_of(spark, sf, runs, lateness: str = "10 minutes") -> DataFrame:
    """Runs of payments stored one after another, the timeline's stream drained after each."""
    store, checkpoint = TableStore(spark, workspace(spark, "store")), workspace(spark, "checkpoint")
    rows = projections.transaction_rows(derived.scored_events(spark, sf))
    for run, condition in runs:
        store.write_run(run, {"transactions": rows.filter(condition)})
        _drain_timeline(store, checkpoint, lateness)
    return fraud_timeline(store)


@query("t02_fraud_timeline")
def timeline(spark, sf):
    """Windows of event time over the stream of stored payments, drained."""
    return _timeline_of(spark, sf, [("batch-0", "true")])


@query("t02_replayed_timeline")
def replayed_timeline(spark, sf):
    """The first half of the month, then the second, then the second written again, as after a crash."""
    first = "transaction_timestamp < timestamp_ntz'2024-01-16'"
    return _timeline_of(spark, sf, [("a-0", first), ("a-1", f"NOT {first}"), ("a-1", f"NOT {first}")], "40 days")


@query("t02_late_events")
def late_timeline(spark, sf):
    """All but every third payment up to noon of the 16th, then the rest: what is older than two days by then is too late."""
    late = "hash_of_id % 3 = 0"
    store, checkpoint = TableStore(spark, workspace(spark, "store")), workspace(spark, "checkpoint")
    rows = projections.transaction_rows(derived.scored_events(spark, sf)).withColumn("hash_of_id", derived.number_of())
    early = F.expr(f"transaction_timestamp < timestamp_ntz'2024-01-16 12:00:00' AND NOT {late}")
    for run, part in (("a-0", rows.filter(early)), ("a-1", rows.filter(~early))):
        store.write_run(run, {"transactions": part})
        _drain_timeline(store, checkpoint, "2 days")
    return fraud_timeline(store)


@query("t03_drop_duplicates")
def drop_duplicates(spark, sf):
    unique = keep_first(damaged_transactions(spark, sf), order=("processed_at",))
    return unique.select("transaction_id")


@query("t03_drop_stored")
def drop_already_stored(spark, sf):
    """All transactions against a store that already holds the normal ones."""
    tx = transactions(spark, sf)
    return drop_stored(tx, tx.filter("transaction_status = 'NORMAL'")).select("transaction_id")


@query("t03_stream_duplicates")
def stream_duplicates(spark, sf):
    """The message files twice over, in different batches; each id must be stored once."""
    folder, store, checkpoint = _message_folder(spark, sf), TableStore(spark, workspace(spark, "store")), workspace(
        spark, "checkpoint"
    )
    _drain(spark, folder, store, checkpoint, _per_batch(spark, sf))
    reports.publish_text(derived.json_messages(spark, sf).repartition(_files(spark, sf, 2)), folder)
    _drain(spark, folder, store, checkpoint, _per_batch(spark, sf))
    return store.read("transactions")


@query("x01_maintained_reports")
def maintained_reports(spark, sf):
    """Daily reports stored for most rows, then refreshed for late rows that fall on a few dates."""
    store = TableStore(spark, workspace(spark, "store"))
    rows = projections.transaction_rows(derived.scored_events(spark, sf))
    late = F.dayofmonth("transaction_timestamp").isin(7, 19) & (derived.number_of() % 4 == 0)
    for run, part in (("a-0", rows.filter(~late)), ("a-1", rows.filter(late))):
        store.write_run(run, {"transactions": part})
        daily.refresh_reports(store, store.read("transactions", run_id=run))
    return store.read("daily_reports")


@query("t03_bounded_memory")
def bounded_memory(spark, sf):
    """The message files twice over, by a stream that remembers an id for a day after it came."""
    folder, store, checkpoint = _message_folder(spark, sf), TableStore(spark, workspace(spark, "store")), workspace(
        spark, "checkpoint"
    )
    for _ in range(2):
        _drain(spark, folder, store, checkpoint, _per_batch(spark, sf), within="1 day")
        reports.publish_text(derived.json_messages(spark, sf).repartition(_files(spark, sf, 2)), folder)
    return store.read("transactions")


REGISTRY["x02_user_dimension"] = derived.users
REGISTRY["x02_rated_users"] = _over(damaged_transactions, lambda tx: users.rated_users(users.user_history(tx)))


@query("x02_merged_history")
def merged_users(spark, sf):
    """The same from the histories of three parts of the rows."""
    tx = damaged_transactions(spark, sf).withColumn("part", F.dayofmonth("processed_at") % 3)
    parts = [users.user_history(tx.filter(F.col("part") == k)) for k in range(3)]
    return users.rated_users(users.merged(*parts))


REGISTRY["x04_surrogate_keys"] = _over(fraud_alerts, lambda a: a.select("alert_id", "transaction_id"))
