"""Intermediate tables that outlive the executors which made them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from riskstream.session import shared_root


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder; Spark removes the files it cleans up."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


#: Bytes of a table that may be broadcast.
BROADCAST_BYTES = 1 << 25


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df``, flat columns of numbers and texts, computed once; with a hint to broadcast it if it is small."""
    kept = cut(df)
    width = sum(
        (
            F.coalesce(F.octet_length(field.name), F.lit(0))
            if isinstance(field.dataType, (StringType, BinaryType))
            else F.lit(16)
            for field in df.schema
        ),
        F.lit(8),
    )
    size = kept.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(kept) if size <= (BROADCAST_BYTES if limit is None else limit) else kept


#: Rows of a batch that Python takes at once: of long texts the usual ten thousand would fill a worker.
BATCH_ROWS = 500


def texts(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands rows to Python in batches small enough for long texts."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/llm/{tag}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``new_folder``, through Spark's own file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
