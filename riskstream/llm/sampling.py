"""Bounded samples by hash, cut before anything is sorted."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_for(wanted: int, total: int) -> float:
    """The share of ``total`` keys that leaves at least ``wanted`` of them, by eight standard deviations."""
    return min(1.0, (wanted + 8 * math.sqrt(wanted) + 64) / max(total, 1))


def smallest_hashes(key: str, share: Column | float) -> Column:
    """True for the keys whose hash lies in the lowest ``share`` of all hashes."""
    share = F.lit(float(share)) if not isinstance(share, Column) else share
    return F.xxhash64(key).cast("double") <= F.lit(-(2.0**63)) + share * F.lit(2.0**64)
