"""Keyed message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic from its latest offset on.

    Needs Spark's Kafka connector on the class path. ``minPartitions`` and
    ``maxOffsetsPerTrigger`` may be passed to widen and bound the micro-batches.
    """
    reader = spark.readStream.format("kafka").option("startingOffsets", "latest")
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    return reader.options(**settings).load()


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of JSON lines as a stream with the same ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
