"""Aggregates whose result does not depend on how rows are spread over tasks.

The same measures exist over stored transactions (``ROWS``) and over their activity cube
(``CUBE``), so a report function serves both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream.functions.predicates import is_fraud
from riskstream.schemas import MONEY_TOTAL


class RowMeasures:
    """Measures over one row per transaction."""

    def count_where(self, condition: Column) -> Column:
        return F.count_if(condition)

    def _count(self) -> Column:
        return F.count(F.lit(1))

    def _sum(self, name: str) -> Column:
        return F.sum(name)

    def _known(self, name: str) -> Column:
        return F.count(name)

    def _max(self, name: str) -> Column:
        return F.max(name)

    def _fraud_money(self) -> Column:
        return F.sum(F.when(is_fraud(), F.col("amount")))

    def rows(self, alias: str) -> Column:
        return self._count().alias(alias)

    def rows_with_status(self, status: str) -> Column:
        return self.count_where(F.col("transaction_status") == status).alias(f"total_{status.lower()}")

    def fraud_money(self, alias: str) -> Column:
        return F.coalesce(self._fraud_money(), F.lit(0)).cast(MONEY_TOTAL).alias(alias)

    def mean(self, name: str) -> Column:
        """Mean over the non-null values, 0.0 when there are none.

        The sum of a decimal or integer column is exact, so only the last division rounds and
        the result is the same for any partitioning.
        """
        exact = F.try_divide(self._sum(name).cast("double"), self._known(name))
        return F.coalesce(exact, F.lit(0.0)).alias(f"avg_{name}")

    def peak(self, name: str, kind="int") -> Column:
        return F.coalesce(self._max(name), F.lit(0).cast(kind)).alias(f"max_{name}")


class CubeMeasures(RowMeasures):
    """The same measures over one row per combination, which stands for ``cell_rows`` rows."""

    def count_where(self, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("cell_rows"))), F.lit(0)).cast("bigint")

    def _count(self) -> Column:
        return self.count_where(F.lit(True))

    def _sum(self, name: str) -> Column:
        if name == "ml_probability":
            return F.sum("probability_sum")
        return F.sum(F.col(name) * F.col("cell_rows"))

    def _known(self, name: str) -> Column:
        if name == "ml_probability":
            return F.sum("probability_known")
        return self.count_where(F.col(name).isNotNull())

    def _max(self, name: str) -> Column:
        return F.max("probability_max" if name == "ml_probability" else name)

    def _fraud_money(self) -> Column:
        return F.sum(F.when(is_fraud(), F.col("amount_sum")))


ROWS = RowMeasures()
CUBE = CubeMeasures()
