"""Surrogate keys 1..n without a one-task sort.

Rows are written once, in order where an order is asked for. A row's key is then
the number of rows in the files before its own plus its position in the file,
both known from the files, so numbering is a map-only read. The written files
also make it safe to lose executors: a retried task reads the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Names of written files: the task, a random id, the part of the task, suffixes.
FILE_NAME = r"^part-\d+-[^.]*-c\d+\.[a-z0-9.]+$"


def write_ordered(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Write ``df`` in global ``order`` (file by file), or as it is without one.

    Ranges come from a sample of the keys; without a fixed partition number AQE
    merges neighbouring small ranges.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("overwrite").parquet(path)


def read_numbered(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The rows of ``path`` with a dense key, in the order of the files.

    A file name is ``part-<task>-<id>-c<part>.<suffix>``; the id is random and may
    hold anything, so only the anchored ends of the name are read. The number of
    a task's part tells its files apart. A name of another form stops the load.
    """
    schema = spark.read.parquet(path).columns
    rows = spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.row_index").alias("file_row"),
    )
    name = F.col("file_name")
    number = lambda pattern: F.when(
        name.rlike(FILE_NAME), F.regexp_extract(name, pattern, 1).cast("bigint")
    ).otherwise(F.raise_error(F.concat(F.lit("not a written part file: "), name)).cast("bigint"))
    sizes = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("file_rows"))
    # One row per written file, a list the driver holds anyway to plan the scan.
    # The planner broadcasts it only while its size allows.
    before = Window.orderBy("file_task", "file_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "file_name", "file_rows",
        number(r"^part-(\d+)-").alias("file_task"), number(r"-c(\d+)\.[a-z0-9.]+$").alias("file_part"),
    ).select(
        "file_name", F.coalesce(F.sum("file_rows").over(before), F.lit(0)).alias("rows_before"),
    )
    return rows.join(offsets, "file_name").select(
        (F.col("rows_before") + F.col("file_row") + 1).alias(key), *schema
    )


def with_dense_key(
    df: DataFrame, key: str, path: str, order: Sequence[str] = ()
) -> DataFrame:
    """``df`` with a key 1..n in ``order``, staged under ``path``."""
    write_ordered(df, path, order)
    return read_numbered(df.sparkSession, path, key)


def with_lasting_key(
    known: DataFrame, wanted: DataFrame, key: str, natural: str, path: str
) -> DataFrame:
    """``known`` brought up to ``wanted``: keys once given out stay, new ones follow the highest.

    ``known`` has one row per ``natural`` with its ``key``. Its rows take the other columns
    from ``wanted`` where that has them and keep their last ones where it does not, so
    that older references still find them. Of several rows of ``wanted`` with one
    ``natural`` the smallest counts; a NULL is no ``natural``. New rows are numbered in
    the order of ``natural`` after one anti-join; they are staged under ``path``.
    """
    others = [c for c in known.columns if c not in (key, natural)]
    current = wanted.filter(F.col(natural).isNotNull()).groupBy(natural).agg(
        F.min(F.struct(*others)).alias("_now"))
    updated = known.join(current, natural, "left").select(key, natural, *[
        F.when(F.col("_now").isNotNull(), F.col(f"_now.{c}")).otherwise(F.col(c)).alias(c)
        for c in others])
    fresh = current.join(known.select(natural), natural, "left_anti").select(natural, "_now.*")
    last_key = known.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    added = with_dense_key(fresh, key, path, [natural])
    return updated.unionByName(added.withColumn(key, F.col(key) + last_key)).select(*known.columns)
