"""Row predicates shared by reports, checks and repair."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream.schemas import ALERTABLE, ALL_STATUSES, FRAUD, LABEL

SCORES = ("final_score", "ml_probability", "behavior_score", "detection_method")
REQUIRED_FIELDS = ("transaction_id", "user_id", "amount", "event_time")


def has_required_fields() -> Column:
    present = F.lit(True)
    for name in REQUIRED_FIELDS:
        present = present & F.col(name).isNotNull()
    return present


def is_alertable(status: str = "transaction_status") -> Column:
    return F.col(status).isin(*ALERTABLE)


def is_fraud(status: str = "transaction_status") -> Column:
    return F.col(status) == FRAUD


def status_in(selected: Iterable[str] | None = None) -> Column:
    """Keep the selected statuses; an empty selection means every status."""
    wanted = tuple(selected or ()) or ALL_STATUSES
    return F.col("transaction_status").isin(*wanted)


def is_labelled(label: str = "actual_label") -> Column:
    return F.col(label).isNotNull()


def in_class(value: int, label: str = LABEL) -> Column:
    return F.col(label) == value


def has_scores() -> Column:
    present = F.lit(True)
    for name in SCORES:
        present = present & F.col(name).isNotNull()
    return present
