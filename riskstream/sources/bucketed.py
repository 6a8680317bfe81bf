"""Copies of the result tables in buckets of one key, for joins that move no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.predicates import is_alertable

BUCKETS = 256


def write_bucketed(rows: DataFrame, name: str, path: str, key: str = "transaction_id", buckets: int = BUCKETS) -> None:
    """Write ``rows`` as catalog table ``name``, stored at ``path``, in sorted buckets of ``key``.

    Rows are dealt to one task a bucket first, so that a bucket is one sorted file. Rows without a key are written where they
    are, in as many files, as they never meet a partner.
    """
    keyed, loose = rows.filter(F.col(key).isNotNull()), rows.filter(F.col(key).isNull())
    dealt = keyed.repartition(buckets, key).unionByName(loose)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def rows_without_partner(spark: SparkSession, rows: str, partners: str, key: str = "transaction_id", condition=None) -> DataFrame:
    """Rows of one bucketed table whose key is not in the other, those without a key included; no row is shuffled.

    Both tables have equally many buckets of ``key``. A bucket is read by one task, so this suits keys
    that repeat little, as ids of transactions do; ``reconcile`` compares ids that fill much of a table.
    """
    own = spark.table(rows)
    own = own if condition is None else own.filter(condition)
    others = spark.table(partners).filter(F.col(key).isNotNull()).select(key)
    lonely = own.filter(F.col(key).isNotNull()).join(others.hint("merge"), key, "left_anti")
    return lonely.select(*own.columns).unionByName(own.filter(F.col(key).isNull()))


def transactions_without_alert(spark: SparkSession, transactions: str, alerts: str) -> DataFrame:
    return rows_without_partner(spark, transactions, alerts, condition=is_alertable())


def alerts_without_transaction(spark: SparkSession, alerts: str, transactions: str) -> DataFrame:
    return rows_without_partner(spark, alerts, transactions)
