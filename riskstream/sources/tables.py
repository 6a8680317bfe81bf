"""Result tables as Parquet partitioned by day and run, or reached over JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from riskstream.schemas import (
    BATCH_QUALITY,
    DAILY_REPORTS,
    FRAUD_ALERTS,
    FRAUD_MINUTES,
    REJECTED,
    RISK_SCORES,
    SPEND_PROFILES,
    TRANSACTIONS,
    USER_SPEND,
)
from riskstream.session import durable

TABLES = {
    "transactions": TRANSACTIONS,
    "risk_scores": RISK_SCORES,
    "fraud_alerts": FRAUD_ALERTS,
    "rejected_messages": REJECTED,
    "batch_quality": BATCH_QUALITY,
    "spend_profiles": SPEND_PROFILES,
    "user_spend": USER_SPEND,
}
# Tables that hold one row per key and are kept up to date, with the key's own day.
KEYED = {"fraud_minutes": FRAUD_MINUTES, "daily_reports": DAILY_REPORTS}
# The time whose day a table is partitioned by.
DATED_BY = {
    "transactions": "processed_at",
    "risk_scores": "created_at",
    "fraud_alerts": "created_at",
    "rejected_messages": "rejected_at",
    "batch_quality": "observed_at",
    "spend_profiles": "event_time",
    "user_spend": "until",
    "fraud_minutes": "minute",
    "daily_reports": "report_date",
}


class TableStore:
    """Tables below one folder, each partitioned by day.

    Appended tables are partitioned by day and run as well. A run is a micro-batch or a repair; written
    again, it replaces its own partitions and no others (dynamic partition overwrite). A batch's rows
    carry the time of the batch, which a replay keeps, so a replay meets the same partitions. The tables of a
    run are not written at one moment: transactions come last, so a crash leaves no transaction without its alerts, and
    the replay completes it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ------------------------------------------------------------ reading

    def partitions(self, table: str) -> DataFrame:
        """The table's rows with its partition columns; a table not yet written is empty."""
        columns = StructType([*(TABLES | KEYED)[table].fields]).add("day", DateType())
        if table in TABLES:
            columns.add("run", StringType())
        if not self._exists(table):
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(self.path(table))

    def read(self, table: str, run_id: str | None = None, other_than: str | None = None, since=None) -> DataFrame:
        """The table's rows, of one run, or but those of an owner's runs, or from a day on: all by pruned partitions."""
        rows = self.partitions(table)
        if run_id is not None:
            rows = rows.filter(F.col("run") == run_id)
        if other_than is not None:
            rows = rows.filter(~_owned_by(other_than))
        if since is not None:
            rows = rows.filter(F.col("day") >= F.lit(since))
        return rows.select(*(TABLES | KEYED)[table].names)

    def newest(self, table: str, top: int) -> DataFrame:
        """Whole days that hold the ``top`` newest rows, for a listing to sort and cut.

        Days are counted without reading a column.
        """
        rows = self.partitions(table)
        per_day = rows.groupBy("day").agg(F.count(F.lit(1)).alias("rows"))
        newer = Window.orderBy(F.col("day").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        # a row for each day of the table
        needed = per_day.withColumn("newer", F.coalesce(F.sum("rows").over(newer), F.lit(0))).filter(F.col("newer") < top)
        found = needed.agg(F.min("day").alias("since"), F.count_if(F.col("day").isNull()).alias("undated")).first()
        return self.read(table, since=None if found.undated else found.since)

    def stream(self, table: str, **options: str) -> DataFrame:
        """Rows as they are stored. A replayed run is seen again, so a reader that counts drops repeats by key."""
        columns = StructType([*TABLES[table].fields]).add("day", DateType()).add("run", StringType())
        system, path = self._hadoop(self.path(table))
        system.mkdirs(path)  # a stream may start before the first run
        reader = self.spark.readStream.schema(columns).option("ignoreMissingFiles", "true")
        return reader.options(**options).parquet(self.path(table)).select(*TABLES[table].names)

    # ------------------------------------------------------------ writing

    def write_run(self, run_id: str, tables: dict[str, DataFrame], one_day: bool = False) -> None:
        """Write the tables of a run in the given order, each in place of what the run had in the same days.

        Rows of many days are rebalanced by day first, so that a day has few files; rows of
        ``one_day``, as a micro-batch has them, stay where they are.
        """
        for table, rows in tables.items():
            dated = rows.select(*TABLES[table].names, F.to_date(DATED_BY[table]).alias("day"), F.lit(run_id).alias("run"))
            self._overwrite(table, dated if one_day else dated.hint("rebalance", "day"), "day", "run")

    def upsert(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        """Put rows in place of those with the same keys. Only the days that they touch are read and written.

        The merged days are kept in the shared folder before they replace what they were read from. A day is not
        replaced at one moment: what is kept this way can be made again from the transactions.
        """
        rows = durable(rows.withColumn("day", F.to_date(DATED_BY[table])))
        days = rows.select("day").distinct()
        kept = self.partitions(table).join(F.broadcast(days), "day", "left_semi")  # one row a day
        merged = durable(kept.join(rows.select(*keys), keys, "left_anti").unionByName(rows.select(kept.columns)))
        self._overwrite(table, merged.hint("rebalance", "day"), "day")

    def _overwrite(self, table: str, rows: DataFrame, *partitions: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(self.path(table))

    # ------------------------------------------------------------ owners

    def other_owners(self, owner: str) -> bool:
        """Register ``owner``, and tell whether others have written here. One marker an owner, not one a run."""
        system, folder = self._hadoop(f"{self.root}/_owners")
        system.mkdirs(self._hadoop(f"{self.root}/_owners/{owner}")[1])
        return len(system.listStatus(folder)) > 1

    def _hadoop(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _exists(self, table: str) -> bool:
        system, path = self._hadoop(self.path(table))
        return system.exists(path)


def _owned_by(owner: str) -> Column:
    """Runs of an owner are named ``<owner>`` or ``<owner>-<number>``."""
    return (F.col("run") == owner) | F.col("run").startswith(f"{owner}-")


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table in a database. Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` for a parallel read, and ``driver``, ``user``, ``password`` as needed."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def append_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Append rows to a database table; a key clash fails the write, as keys are the database's."""
    rows.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()
