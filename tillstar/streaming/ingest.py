"""Incremental ingestion of growing sales files.

Every micro-batch goes through the same operators as the full refresh and is
written to a folder named by its batch id, so a batch repeated after a failure
replaces itself. Lines already taken in by an earlier batch are rejects of the
unique key, so that kept lines and the copies of rejects add up to what arrived.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.fact import Dimensions, build_fact
from tillstar.operators.sales import LINE_KEY, UNIQUE_LINE, split_sales, typed_sales
from tillstar.sources.landed import (
    CSV_OPTIONS,
    SALES_COLUMNS,
    Source,
    fill_missing,
    normalise_headers,
    registry_frame,
    stamp_source,
)

BATCH = "batch"


def stream_sales(
    spark: SparkSession,
    root: str,
    header: Sequence[str],
    sources: Sequence[Source],
    files_per_batch: int | None = None,
) -> DataFrame:
    """Landed sales files as a stream of raw lines.

    One stream serves the sources that share ``header``; the reader stops at a
    file with another one.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.readStream.options(
        **CSV_OPTIONS, header=True, enforceSchema=False).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(f"{root}/*")
    named = rows.select(
        *[rows[f"`{cell}`"].alias(name) for cell, name in zip(header, normalise_headers(header))],
        F.col("_metadata.file_path").alias("source_path"),
    )
    wanted = [c for c in SALES_COLUMNS if c not in ("store_id", "source_sheet")]
    filled = fill_missing(named, [*wanted, "source_path"])
    return stamp_source(filled, registry_frame(spark, sources)).select(*SALES_COLUMNS)


def ingest_sales(raw: DataFrame, out: str, checkpoint: str) -> None:
    """Take in everything that has arrived; typed lines and rejects go under ``out``.

    A line is known if an earlier batch kept the same (receipt, product); only
    these two columns of the stored lines are read. A store that cannot be read
    stops the batch.
    """
    key = T.StructType([
        *[T.StructField(c, T.StringType()) for c in LINE_KEY], T.StructField(BATCH, T.LongType())])

    def take_in(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        split = split_sales(batch, f"{out}/repeated/{BATCH}={batch_id}")
        fresh, rejected = split.lines, split.rejected
        if batch_id > 0:
            stored = spark.read.schema(key).parquet(f"{out}/sales")
            known = stored.filter(F.col(BATCH) < batch_id).select(*LINE_KEY)
            again = fresh.join(known, list(LINE_KEY), "left_semi")
            rejected = rejected.unionByName(again.select(
                "*", F.lit(UNIQUE_LINE).alias("failed_checks"),
                F.lit(1).cast("bigint").alias("copies")))
            fresh = fresh.join(known, list(LINE_KEY), "left_anti")
        typed_sales(fresh).write.mode("overwrite").parquet(f"{out}/sales/{BATCH}={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{out}/rejected/{BATCH}={batch_id}")

    _run(raw.writeStream.foreachBatch(take_in), checkpoint)


def enrich_sales(
    sales: DataFrame, dims: Dimensions, flagged: DataFrame, out: str, checkpoint: str
) -> None:
    """Match everything that has arrived with the dimensions and append it to a fact folder.

    The stream meets only static sides, so no state is kept, and the file sink
    commits each micro-batch once.
    """
    fact = build_fact(sales, dims, flagged)
    _run(fact.writeStream.format("parquet").option("path", out), checkpoint)


def _run(writer, checkpoint: str) -> None:
    stream = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    stream.awaitTermination()
