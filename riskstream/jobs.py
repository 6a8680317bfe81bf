"""Commands of ``run.py``, the file to pass to spark-submit: one per job.

    spark-submit run.py score   --store URI --messages URI --model URI --checkpoint URI
    spark-submit run.py train   --data URI --model URI --metrics URI
    spark-submit run.py daily|evaluate|quality|repair --store URI --reports URI
    spark-submit run.py timeline --store URI --checkpoint URI
    spark-submit run.py averages --store URI --checkpoint URI
    spark-submit run.py refresh --store URI --since DAY
    spark-submit run.py export  --store URI --jdbc URL
    spark-submit run.py publish --data URI --kafka SERVERS --topic NAME
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame

from riskstream.operators import quality
from riskstream.operators.repair import repair
from riskstream.plans import daily, evaluation, training
from riskstream.session import build_session
from riskstream.sinks.reports import CSV_OPTIONS, keyed_messages, publish_kafka, write_csv, write_record
from riskstream.sources.labelled import labelled_csv
from riskstream.sources.messages import file_messages, kafka_messages
from riskstream.sources.models import load_pipeline, pipeline_scorer
from riskstream.sources.tables import TABLES, TableStore, append_jdbc
from riskstream.streaming.averages import start_averages
from riskstream.streaming.scoring import BatchWriter, start_rejects, start_scoring
from riskstream.streaming.timeline import LATENESS, start_timeline


def write_daily_report(transactions: DataFrame, folder: str, at: datetime) -> dict[str, str]:
    """The four daily CSV reports; only the alert listing has no bound on its size."""
    small = {
        "fraud_summary": daily.daily_summary(transactions),
        "fraud_status_distribution": daily.status_breakdown(transactions),
        "fraud_top_countries": daily.top_alert_countries(transactions),
    }
    paths = {name: write_csv(report, folder, name, at) for name, report in small.items()}
    details = daily.alert_details(transactions)
    return {**paths, "fraud_details": write_csv(details, folder, "fraud_details", at, small=False)}


def write_evaluation_report(transactions: DataFrame, folder: str, at: datetime) -> dict[str, str]:
    reports = {
        "model_evaluation_metrics": evaluation.confusion_metrics(transactions),
        "model_evaluation_distribution": evaluation.label_status_breakdown(transactions),
        "model_top_predictions": evaluation.top_predictions(transactions),
    }
    return {name: write_csv(report, folder, name, at) for name, report in reports.items()}


def check_quality(store: TableStore, folder: str, at: datetime, strict: bool = True) -> str:
    """Write the quality report, then fail if a check failed."""
    report = quality.quality_report(store.read("transactions"), store.read("fraud_alerts"))
    path = write_csv(report, folder, "data_quality_report", at)
    if strict:
        # The gate reads what was written, so the checks run once and both always agree.
        quality.enforce(store.spark.read.options(**CSV_OPTIONS).schema(report.schema).csv(path))
    return path


def repair_alerts(store: TableStore, folder: str, at: datetime) -> str:
    report = repair(store, f"{at:%Y%m%d%H%M%S}")
    return write_csv(report, folder, "repair_missing_alerts", at, small=False)


def train_model(spark, data: str, model_path: str, metrics_path: str) -> dict:
    fitted = training.train(labelled_csv(spark, data), model_path=model_path)
    training.save_pipeline(fitted.model, model_path)
    write_record(training.metrics_record(spark, fitted.metrics), metrics_path)
    return fitted.metrics


def score_stream(spark, args) -> None:
    store = TableStore(spark, args.store)
    writer = BatchWriter(store, pipeline_scorer(load_pipeline(args.model)))
    if args.kafka:
        bounds = {"maxOffsetsPerTrigger": args.batch_messages, "minPartitions": args.min_partitions}
        options = {name: str(value) for name, value in bounds.items() if value}
        messages = kafka_messages(spark, args.kafka, args.topic, **options)
    else:
        messages = file_messages(spark, args.messages, args.batch_files)
    trigger = {"availableNow": True} if args.once else {}
    streams = [
        start_scoring(messages, writer, f"{args.checkpoint}/scored", args.remember, **trigger),
        start_rejects(messages, store, f"{args.checkpoint}/rejected", **trigger),
    ]
    if not args.once:
        spark.streams.awaitAnyTermination()  # with its error, if one stream fails
    for stream in streams:
        stream.awaitTermination()


def _arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskstream")
    commands = parser.add_subparsers(dest="command", required=True)
    score = commands.add_parser("score")
    score.add_argument("--store", required=True)
    score.add_argument("--model", required=True)
    score.add_argument("--checkpoint", required=True)
    source = score.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of JSON lines")
    source.add_argument("--kafka", help="bootstrap servers")
    score.add_argument("--topic", default="transactions_raw")
    score.add_argument("--batch-messages", type=int, default=1_000_000, help="messages of a topic per batch")
    score.add_argument("--min-partitions", type=int, help="tasks that read the topic")
    score.add_argument("--batch-files", type=int, default=1000, help="files of a folder per batch")
    score.add_argument("--remember", help="forget an id this long after it came, e.g. '7 days'; never by default")
    score.add_argument("--once", action="store_true", help="drain what is there and stop")
    train = commands.add_parser("train")
    for name in ("--data", "--model", "--metrics"):
        train.add_argument(name, required=True)
    for name in ("daily", "evaluate", "quality", "repair"):
        report = commands.add_parser(name)
        report.add_argument("--store", required=True)
        report.add_argument("--reports", required=True)
    live = commands.add_parser("timeline", help="keep the frauds per minute up to date")
    for name in ("--store", "--checkpoint"):
        live.add_argument(name, required=True)
    live.add_argument("--lateness", default=LATENESS, help="how much older than the newest an event may be")
    live.add_argument("--once", action="store_true", help="drain what is there and stop")
    averages = commands.add_parser("averages", help="keep what users spent before each transaction")
    for name in ("--store", "--checkpoint"):
        averages.add_argument(name, required=True)
    averages.add_argument("--once", action="store_true", help="drain what is there and stop")
    refresh = commands.add_parser("refresh", help="recompute the daily reports that new rows touch")
    refresh.add_argument("--store", required=True)
    refresh.add_argument("--since", type=date.fromisoformat, required=True, help="first day of the new rows")
    export = commands.add_parser("export", help="append the result tables to a database")
    export.add_argument("--store", required=True)
    export.add_argument("--jdbc", required=True, help="URL")
    publish = commands.add_parser("publish", help="send labelled rows as messages to a topic")
    publish.add_argument("--data", required=True)
    publish.add_argument("--kafka", required=True, help="bootstrap servers")
    publish.add_argument("--topic", default="transactions_raw")
    return parser.parse_args(argv)


def export_tables(store: TableStore, url: str) -> list[str]:
    """Append every result table to the database; returns their names."""
    for name in TABLES:
        append_jdbc(store.read(name), url, name)
    return list(TABLES)


def publish_rows(spark, data: str, servers: str, topic: str) -> str:
    """Labelled rows as keyed messages, the row time as the key."""
    publish_kafka(keyed_messages(labelled_csv(spark, data), key="Time"), servers, topic)
    return topic


def main(argv=None) -> None:
    args = _arguments(argv)
    spark = build_session(f"riskstream {args.command}")
    now = datetime.now()
    if args.command == "score":
        score_stream(spark, args)
    elif args.command == "train":
        print(train_model(spark, args.data, args.model, args.metrics))
    elif args.command == "timeline":
        store, trigger = TableStore(spark, args.store), {"availableNow": True} if args.once else {}
        stream = start_timeline(store.stream("transactions"), store, args.checkpoint, args.lateness, **trigger)
        stream.awaitTermination()
    elif args.command == "averages":
        store, trigger = TableStore(spark, args.store), {"availableNow": True} if args.once else {}
        start_averages(store.stream("transactions"), store, args.checkpoint, **trigger).awaitTermination()
    elif args.command == "refresh":
        store = TableStore(spark, args.store)
        daily.refresh_reports(store, store.read("transactions", since=args.since))
    elif args.command == "export":
        print(export_tables(TableStore(spark, args.store), args.jdbc))
    elif args.command == "publish":
        print(publish_rows(spark, args.data, args.kafka, args.topic))
    else:
        store = TableStore(spark, args.store)
        transactions = store.read("transactions")
        run = {
            "daily": lambda: write_daily_report(transactions, args.reports, now),
            "evaluate": lambda: write_evaluation_report(transactions, args.reports, now),
            "quality": lambda: check_quality(store, args.reports, now),
            "repair": lambda: repair_alerts(store, args.reports, now),
        }
        print(run[args.command]())
