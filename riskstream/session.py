"""Session set-up and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "riskstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on.

    The shuffle width is left to the cluster's own setting: adaptive execution
    coalesces small partitions and splits skewed ones, so no number fits every load.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="riskstream-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def workspace(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/riskstream/{tag}-{uuid.uuid4().hex}"


def durable(df):
    """``df`` computed once and kept in the shared folder.

    The result has no lineage to its inputs, so it stays what it was even if an executor is lost
    after those inputs have changed. Spark deletes the files once nothing refers to the result
    any more, in sessions with the cleaner setting of :func:`build_session`.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
