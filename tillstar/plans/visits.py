"""Customer visits that follow a fact kept by month, without reading all of it.

For each month that a load built again, the bitmaps of that month are built from its
part of the fact; those of the other months stay as they are. The customers of a
state are the bitmaps of its months merged. A month that lost lines, since a receipt was
flagged late, is right as well: its old bitmaps belong to the load before.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tillstar.operators.keys import with_dense_key
from tillstar.operators.visits import NUMBER, customer_receipts, merged_visits, visit_bitmaps
from tillstar.plans.months import Load, MonthlySales
from tillstar.sources.layers import MONTH

_LOG = "number bigint, build string, last_receipt bigint, months map<string,string>"
_RECEIPTS = f"receipt_no string, {NUMBER} bigint, build string"
_BITMAPS = ("customer_phone string, bucket bigint, first_seen_date date, receipts binary,"
            f" build string, {MONTH} string")


class MonthlyVisits:
    """Bitmaps beside the fact of ``sales``, under its root.

    A build writes folders of its own, and one appended row publishes it: the loads whose
    months it holds and the last receipt number given out. A build that fails leaves no
    trace but its folders. Receipts keep their numbers for good.
    """

    def __init__(self, sales: MonthlySales) -> None:
        self.sales, self.spark, self.root = sales, sales.spark, f"{sales.root}/visits"

    def add(self, state: Load | None = None) -> list[str]:
        """Build the months of ``state`` that have no bitmaps yet, and name them."""
        state = state or self.sales.published()
        log = self._builds()
        held = {(month, load) for b in log for month, load in b["months"].items()}
        missing = {m: load for m, load in state.months.items() if (m, load) not in held}
        if not missing:
            return []
        number = log[-1]["number"] + 1 if log else 1
        last = log[-1]["last_receipt"] if log else 0
        build = f"{number:06d}-{uuid.uuid4().hex[:8]}"
        stage = f"{self.root}/stage/{build}"
        lines = self.sales.fact(state).filter(F.col(MONTH).isin(sorted(missing)))
        receipts = self._written(customer_receipts(lines, MONTH), f"{stage}/receipts")
        known = self._known(log)
        # New receipts are numbered customer by customer, so that those of one customer
        # share few bitmaps.
        fresh = receipts.filter(F.col("receipt_no").isNotNull()).groupBy("receipt_no").agg(
            F.min("customer_phone").alias("first_phone")).join(known, "receipt_no", "left_anti")
        numbered = with_dense_key(fresh, NUMBER, f"{stage}/fresh", ["first_phone", "receipt_no"])
        added = self._written(
            numbered.select("receipt_no", (F.col(NUMBER) + last).alias(NUMBER)),
            f"{self.root}/receipts/build={build}")
        bitmaps = visit_bitmaps(receipts, known.unionByName(added), MONTH)
        bitmaps.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(
            f"{self.root}/bitmaps/build={build}")
        row = [(number, build, last + added.count(), missing)]
        self.spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").parquet(
            f"{self.root}/published")
        return sorted(missing)

    def bitmaps(self, state: Load | None = None) -> DataFrame:
        """The bitmaps of the months of ``state``; a month without any stops the read."""
        state = state or self.sales.published()
        at = {(m, load): b["build"] for b in self._builds() for m, load in b["months"].items()}
        months: dict[str, list[str]] = {}
        for month, load in state.months.items():
            if (month, load) not in at:
                raise LookupError(f"no visits of {month} as of load {load}: add the state first")
            months.setdefault(at[month, load], []).append(month)
        if not months:
            return self.spark.createDataFrame([], _BITMAPS).drop("build")
        rows = self.spark.read.schema(_BITMAPS).parquet(f"{self.root}/bitmaps")
        mine = [(F.col("build") == build) & F.col(MONTH).isin(some)
                for build, some in months.items()]
        return rows.filter(reduce(or_, mine)).drop("build")

    def customers(self, state: Load | None = None) -> DataFrame:
        """What ``customer_visits`` gives for the fact of ``state``."""
        return merged_visits(self.bitmaps(state))

    def _builds(self) -> list[Row]:
        """One row per build, in order: all that the driver sees."""
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.root}/published")
        except AnalysisException:
            return []
        return sorted(log.collect(), key=lambda b: b["number"])

    def _known(self, log: list[Row]) -> DataFrame:
        if not log:
            return self.spark.createDataFrame([], _RECEIPTS).drop("build")
        rows = self.spark.read.schema(_RECEIPTS).parquet(f"{self.root}/receipts")
        return rows.filter(F.col("build").isin([b["build"] for b in log])).drop("build")

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
