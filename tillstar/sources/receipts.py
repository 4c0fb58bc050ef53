"""Sales lines laid out by receipt, so that lookups and keys by receipt need no shuffle.

Lines are written once into buckets of their receipt number, sorted, as a table of the
session's catalog, which is what tells the planner about the buckets. A bucket is
read by one task, so receipts with very many lines, and lines without a receipt, are
kept apart in a plain table, where they are shuffled and split like any others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import constraints
from tillstar.operators.fact import without_flagged

RECEIPT = "receipt_no"
#: Receipts with more lines are hot; there are at most lines / HOT_LINES of them.
HOT_LINES = 1_000_000


@dataclass(frozen=True)
class ByReceipt:
    """``bucketed`` holds the lines of all other receipts, ``hot`` those of hot ones."""

    bucketed: DataFrame
    hot: DataFrame

    def each(self, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``operator`` on both parts; it must treat every receipt by itself."""
        return operator(self.bucketed).unionByName(operator(self.hot))


def write_by_receipt(
    sales: DataFrame, table: str, path: str, buckets: int, hot_lines: int = HOT_LINES
) -> ByReceipt:
    """Lay out ``sales`` as catalog table ``table`` with ``buckets`` buckets under ``path``.

    The sales are read three times: for the receipts' sizes, which are combined before
    the shuffle, and for either part.
    """
    spark = sales.sparkSession
    sales.groupBy(RECEIPT).agg(F.count(F.lit(1)).alias("lines")).filter(
        F.col(RECEIPT).isNotNull() & (F.col("lines") > hot_lines)
    ).select(RECEIPT).write.mode("overwrite").parquet(f"{path}/hot_receipts")
    hot = spark.read.parquet(f"{path}/hot_receipts")
    known = sales.filter(F.col(RECEIPT).isNotNull())
    known.join(hot, RECEIPT, "left_anti").select(*sales.columns).write.mode("overwrite").option(
        "path", f"{path}/bucketed").bucketBy(buckets, RECEIPT).sortBy(RECEIPT).saveAsTable(table)
    apart = known.join(hot, RECEIPT, "left_semi").unionByName(
        sales.filter(F.col(RECEIPT).isNull()))
    apart.select(*sales.columns).write.mode("overwrite").parquet(f"{path}/hot")
    return read_by_receipt(spark, table, path)


def read_by_receipt(spark: SparkSession, table: str, path: str) -> ByReceipt:
    bucketed = spark.table(table)
    return ByReceipt(bucketed, spark.read.schema(bucketed.schema).parquet(f"{path}/hot"))


def exclude_flagged(sales: ByReceipt, flagged: DataFrame) -> DataFrame:
    """``without_flagged``; only the flagged receipts are shuffled to meet the buckets."""
    return sales.each(lambda part: without_flagged(part, flagged).select(*part.columns))


def repeated_keys(sales: ByReceipt, *others: str) -> DataFrame:
    """``constraints.repeated_keys`` of (receipt, ``others``), counted within the buckets."""
    return sales.each(lambda part: constraints.repeated_keys(part, [RECEIPT, *others]))
