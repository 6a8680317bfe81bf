"""Agreement between transactions and their alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.predicates import is_alertable
from riskstream.operators.lookup import ROWS_PER_SLICE, lookup
from riskstream.session import durable


def _per_id(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per id: transaction rows, alertable rows, alert rows.

    One union and one aggregation instead of two joins. Rows are counted before the
    shuffle, so an id, or the null id, that fills a third of a table becomes one row per task.
    """
    one, none = F.lit(1), F.lit(0)
    transaction_side = transactions.select(
        "transaction_id",
        one.alias("seen"),
        F.when(is_alertable(), 1).otherwise(0).alias("due"),
        none.alias("alerted"),
    )
    alert_side = alerts.select("transaction_id", none.alias("seen"), none.alias("due"), one.alias("alerted"))
    return (
        transaction_side.unionByName(alert_side)
        .groupBy("transaction_id")
        .agg(*[F.sum(c).alias(c) for c in ("seen", "due", "alerted")])
    )


def _unmatched(own: str, other: str) -> Column:
    """Rows of ``own`` without a partner; a null id never has one."""
    lonely = F.col("transaction_id").isNull() | (F.col(other) == 0)
    return F.coalesce(F.sum(F.when(lonely, F.col(own))), F.lit(0)).cast("bigint")


def key_checks(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row with the three counts that need ids compared across rows."""
    return _per_id(transactions, alerts).agg(
        F.count_if(F.col("seen") > 1).alias("duplicated_transaction_id"),
        _unmatched("alerted", "seen").alias("fraud_alert_without_transaction"),
        _unmatched("due", "alerted").alias("fraud_transaction_without_alert"),
    )


def rows_without_partner(rows: DataFrame, partners: DataFrame, **lookup_options) -> DataFrame:
    """Rows whose transaction id is not among the partners', null ids included.

    Ids of both sides are counted together, which collapses repeated ids before the shuffle and
    moves no other column. The ids without a partner are written to the shared folder, usually a
    few, and the rows are then fetched by a lookup: past a broadcast of those ids, or, when they
    are many, by a join that spreads the ids with very many rows, known from the same counts.
    """
    slice_rows = lookup_options.get("rows_per_slice", ROWS_PER_SLICE)
    one, none = F.lit(1), F.lit(0)
    counted = (
        rows.select("transaction_id", one.alias("own"), none.alias("other"))
        .unionByName(partners.select("transaction_id", none.alias("own"), one.alias("other")))
        .filter(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.sum("own").alias("key_rows"), (F.sum("other") == 0).alias("_lonely"))
    )
    kept = durable(counted.filter(F.col("_lonely") | (F.col("key_rows") > slice_rows)))
    found = lookup(
        rows,
        kept.filter("_lonely").select("transaction_id", "_lonely"),
        "transaction_id",
        how="left",
        key_counts=kept.select("transaction_id", "key_rows"),
        **lookup_options,
    )
    lonely = F.col("transaction_id").isNull() | F.col("_lonely").isNotNull()
    return found.filter(lonely).select(*rows.columns)


def alerts_without_transaction(alerts: DataFrame, transactions: DataFrame, **lookup_options) -> DataFrame:
    return rows_without_partner(alerts, transactions, **lookup_options)


def transactions_without_alert(transactions: DataFrame, alerts: DataFrame, **lookup_options) -> DataFrame:
    return rows_without_partner(transactions.filter(is_alertable()), alerts, **lookup_options)


def duplicated_ids(transactions: DataFrame) -> DataFrame:
    """Ids stored more than once, with their row counts; the null id counts as one id."""
    counted = transactions.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col("row_count") > 1)
