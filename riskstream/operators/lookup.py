"""Dimension lookup that survives both a huge dimension and a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StructType, TimestampNTZType, TimestampType

from riskstream.session import durable

# A broadcast side may take this much memory, by its row count and the width of its schema.
BROADCAST_BYTES = 256 << 20
# Allowance for a text or binary value, and the overhead of a row in the hash table.
TEXT_BYTES, ROW_BYTES = 64, 32
# Rows of one key that one task may handle before the key is spread over several tasks.
ROWS_PER_SLICE = 2_000_000
NULL_KEY_SLICES = 4096
# Parts of every key when the hot keys themselves are too many for a broadcast.
HOT_PARTS = 64


def row_bytes(schema: StructType) -> int:
    """An upper estimate of a row's size: eight bytes a value, and an allowance for text and nested ones."""
    flat = (BooleanType, NumericType, DateType, TimestampType, TimestampNTZType)
    return ROW_BYTES + sum(16 if isinstance(field.dataType, flat) else TEXT_BYTES for field in schema)


def fits_broadcast(dim: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``dim`` takes at most ``limit`` bytes.

    A plain count: every task sends one number. A limit before it would send rows to one task.
    """
    return dim.count() * row_bytes(dim.schema) <= limit


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    key_counts: DataFrame | None = None,
    spread_by: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Join ``fact`` to ``dim`` (one row per ``key``) without a task that holds a hot key.

    * ``dim`` within ``broadcast_bytes``: broadcast, ``fact`` is not shuffled.
    * beyond it: both sides are shuffled on ``(key, slice)``. A key with more than
      ``rows_per_slice`` rows gets one slice per ``rows_per_slice``; its ``dim`` row is repeated
      once per slice, and its ``fact`` rows are dealt by the hash of ``spread_by``, a unique
      column, or of the whole row. All other keys have the single slice 0. Every row still meets exactly its own ``dim`` row.

    The table of hot keys has at most ``rows / rows_per_slice`` rows, so with the defaults it can be
    broadcast up to 10**12 fact rows. Past that the number of slices reaches the fact side by a lookup of
    its own, in which a key's rows are spread by hash as well. ``key_counts`` (``key``, ``key_rows``) may
    be passed when known.
    """
    if fits_broadcast(dim, broadcast_bytes):
        return fact.join(F.broadcast(dim), key, how)

    if key_counts is None:
        key_counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
    slices_needed = F.ceil(F.col("key_rows") / rows_per_slice).cast("int").alias("_slices")
    # Written once, as both sides use it and its size is checked.
    hot = durable(key_counts.filter(F.col("key_rows") > rows_per_slice).select(key, slices_needed))
    spread_hot = not fits_broadcast(hot, broadcast_bytes)
    if not spread_hot:
        hot = F.broadcast(hot)
    # Exact copies of a row hash alike, so the map partition takes part unless the caller names a
    # unique column. A retried task has the same number and rows, hence the same slices.
    spread = F.xxhash64(spread_by) if spread_by else F.xxhash64(*fact.columns, F.spark_partition_id())
    # Rows without a key match nothing in an outer join, so any slice will do for them.
    slices = F.when(F.col(key).isNull(), NULL_KEY_SLICES).otherwise(F.coalesce(F.col("_slices"), F.lit(1)))
    if spread_hot:
        # the hot keys, each repeated for a fixed number of parts, meet fact rows dealt to those parts
        part = F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.pmod(spread, F.lit(HOT_PARTS)).cast("int"))
        parts = hot.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))))
        counted = fact.withColumn("_part", part).join(parts, [key, "_part"], "left").drop("_part")
    else:
        counted = fact.join(hot, key, "left")
    sliced_fact = counted.withColumn("_slice", F.pmod(spread, slices).cast("int"))
    sliced_dim = dim.join(hot, key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))
    )
    joined = sliced_fact.drop("_slices").join(sliced_dim.drop("_slices"), [key, "_slice"], how)
    return joined.drop("_slice")
