"""One row per transaction id, within a frame, along a stream, and against what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskstream.operators.lookup import BROADCAST_BYTES, fits_broadcast

def keep_first(df: DataFrame, key: str = "transaction_id", order: Sequence[str] = ("event_time",)) -> DataFrame:
    """The first row of every key, ties settled by row content; rows without a key are all kept.

    Catalyst plans the rank filter as a partial group limit before the shuffle: each map task
    sends at most one row per key, so a key repeated in a third of the rows moves few of them.
    """
    window = Window.partitionBy(key).orderBy(*order, F.xxhash64(*df.columns))
    ranked = df.filter(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank").unionByName(df.filter(F.col(key).isNull()))


def drop_repeats(events: DataFrame, key: str = "transaction_id", within: str | None = None, time: str = "received_at") -> DataFrame:
    """The first row seen of every key, over the whole of a stream or within a batch frame.

    A stream keeps the keys in one state store and nothing else, so a batch costs lookups for its own rows only. With
    ``within`` a key is forgotten once the watermark, that long behind the newest ``time``, has passed
    its first row, and the state stays as large as that span; copies that come later are new rows then. A key
    repeated in much of a batch sends its rows to one task, so bound the batch; a batch frame
    compares rows before it moves them.
    """
    if within is None or not events.isStreaming:
        return events.dropDuplicates([key])
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def drop_stored(
    new: DataFrame, stored: DataFrame, key: str = "transaction_id", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``stored``; rows without a key stay.

    ``stored`` is the long table. When the keys of the new rows are few it is only scanned, one
    column wide, past a broadcast of them; otherwise both sides are shuffled once. ``new`` is
    evaluated more than once and should be cached if it is costly.
    """
    keys = new.select(key).filter(F.col(key).isNotNull()).distinct()
    small = fits_broadcast(keys, broadcast_bytes)
    found = stored.select(key).join(F.broadcast(keys) if small else keys, key, "left_semi").distinct()
    # the keys found are a subset of the new ones, so they are as few
    return new.join(F.broadcast(found) if small else found, key, "left_anti")
