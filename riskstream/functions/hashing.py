"""Engine-neutral hash buckets, stable under repartitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SPACE = 2**32


def hash_bucket(*keys: str, seed: int = 42) -> Column:
    """A bucket in [0, 2**32), a function of the key values and the seed alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_below(fraction: float, *keys: str, seed: int = 42) -> Column:
    """True for about ``fraction`` of the key values, and always for the same ones."""
    return hash_bucket(*keys, seed=seed) < int(fraction * BUCKET_SPACE)
