"""Report and record files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Times keep their microseconds; by default CSV files stop at milliseconds.
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def write_csv(report: DataFrame, folder: str, name: str, at: datetime, small: bool = True) -> str:
    """Write ``<folder>/<name>_<time>`` with a header and return that path.

    Small reports become one file. Listings without a bound keep their partitions: a sorted
    frame then gives sorted part files without one task writing everything.
    """
    path = f"{folder.rstrip('/')}/{name}_{at:%Y-%m-%d_%H-%M-%S}"
    if small:
        report = report.coalesce(1)
    report.write.options(**CSV_OPTIONS).csv(path)
    return path


def write_record(record: DataFrame, path: str) -> None:
    """A one-row frame as JSON, replacing an earlier one."""
    record.coalesce(1).write.mode("overwrite").json(path)


def keyed_messages(events: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows as keyed JSON messages; null fields are left out of the JSON."""
    return events.select(F.col(key).alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))


def publish_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send keyed messages to a topic, acknowledged by all replicas and retried.

    Needs Spark's Kafka connector on the class path.
    """
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "5"}
    messages.write.format("kafka").options(**{**settings, **options}).save()


def publish_text(messages: DataFrame, path: str) -> None:
    """Append the message values as JSON lines."""
    messages.select("value").write.mode("append").text(path)
