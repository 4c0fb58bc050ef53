"""Written tables as cut points, and running totals without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import scratch_path

ROWS_PER_BUCKET = 50_000

#: Characters between words in the contracts: the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    It cuts the lineage, survives lost executors and tells the planner the size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: str | Column) -> Column:
    """Words between ASCII blanks; 0 for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """True if crc32 of the id as text leaves ``part`` modulo ``parts``; NULL ids: False."""
    fold = F.crc32(F.col(doc_id).cast("string")) % parts
    return F.coalesce(fold == part, F.lit(False))


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // per_bucket))


def running_before(
    df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[str],
    amount: str, name: str,
) -> DataFrame:
    """Add ``name``: the ``amount`` of all earlier rows of the same group.

    Rows are ordered by ``bucket`` and then by ``order``. Totals of the buckets
    are summed first, so that a window holds one bucket of one group at most and
    a group of any size is spread over tasks. ``group`` columns are not NULL;
    an empty ``group`` is one group of all rows. ``df`` is read twice.
    """
    keys = [*group, "_bucket"]
    rows = df.withColumn("_bucket", bucket)
    totals = rows.groupBy(*keys).agg(F.sum(amount).alias("_total"))
    over = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket")
    starts = totals.select(
        *keys,
        F.coalesce(
            F.sum("_total").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
    )
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(starts, keys).withColumn(
        name, F.col("_start") + F.coalesce(F.sum(amount).over(inner), F.lit(0))
    ).drop("_bucket", "_start")
