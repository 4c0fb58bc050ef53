"""Sales lines known by state: repeated deliveries and receipts with too many lines.

What earlier batches brought is held in the streams' state stores, partitioned by key,
instead of being read from the stored lines again in every batch. The stores keep it on the
executors' disks with a bounded part in memory, so that the keys of all lines fit beside the work.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import fixed_values as fixed
from tillstar.operators.lookups import maybe_among
from tillstar.operators.sales import LINE_KEY, LINE_ORDER, RAW_COLUMNS, UNIQUE_LINE, split_sales
from tillstar.operators.validation import flagged_receipts, receipt_findings
from tillstar.session import scratch_path

BATCH = "batch"
DELIVERED = "delivered_on"
LATE_LINE = "delivered_too_late"
_NEWEST_FIRST = "newest_first"
#: Where state is kept: outside the heap, which keys of all lines would fill. A batch adds what
#: it changed to the checkpoint.
STATE_STORE = {
    "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.changelogCheckpointing.enabled": "true",
    "rocksdb.trackTotalNumberOfRows": "false",
}
_CANDIDATE = T.StructType([
    *[T.StructField(c, T.StringType()) for c in RAW_COLUMNS],
    T.StructField(_NEWEST_FIRST, T.LongType()), T.StructField(BATCH, T.LongType())])
_KEPT = T.StructType([
    *[T.StructField(c, T.StringType()) for c in RAW_COLUMNS],
    T.StructField(DELIVERED, T.TimestampType()), T.StructField(BATCH, T.LongType())])


@dataclass(frozen=True)
class Deduplicated:
    """Folders of one deduplicated store.

    ``candidates`` holds one line per key and batch, ``sales`` the lines kept,
    ``rejected`` what a batch rejects by itself.
    """

    out: str

    def path(self, part: str) -> str:
        return f"{self.out}/{part}"


def ingest_deduplicated(raw: DataFrame, out: str, delay: str) -> None:
    """Take in everything that has arrived; a key known from earlier deliveries is not kept.

    ``raw`` is a stream of raw sales lines with the time of their delivery in
    ``delivered_on``. Each micro-batch is first collapsed by the batch operators to one
    line per (receipt, product), the newest delivery first, so that a hot key reaches the
    state store once per batch. The collapsed lines are then read as a stream of their
    own, whose state holds each key for ``delay`` after its delivery. Lines older than
    the watermark (``delay`` before the newest delivery so far) are not kept either;
    ``outcomes`` tells them apart, so every delivered line has one outcome.

    A batch repeated after a failure overwrites its candidates; the state knows those
    it has seen, and the file sink commits each micro-batch once.
    """
    store = Deduplicated(out)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        lines = batch.withColumn(_NEWEST_FIRST, -F.unix_micros(DELIVERED))
        split = split_sales(
            lines, store.path(f"repeated/{BATCH}={batch_id}"), order=(_NEWEST_FIRST, *LINE_ORDER))
        split.rejected.drop(_NEWEST_FIRST).write.mode("overwrite").parquet(
            store.path(f"rejected/{BATCH}={batch_id}"))
        split.lines.write.mode("overwrite").parquet(store.path(f"candidates/{BATCH}={batch_id}"))
        _keep_new_keys(batch.sparkSession, store, delay)

    _run(raw.sparkSession, raw.writeStream.foreachBatch(take_in), store.path("checkpoints/lines"))


def _keep_new_keys(spark: SparkSession, store: Deduplicated, delay: str) -> None:
    """The candidates that arrived since the last call, as one micro-batch."""
    arriving = spark.readStream.schema(_CANDIDATE).option("ignoreMissingFiles", True).parquet(
        store.path("candidates"))
    fresh = arriving.select(
        *RAW_COLUMNS, F.timestamp_micros(-F.col(_NEWEST_FIRST)).alias(DELIVERED), BATCH,
    ).withWatermark(DELIVERED, delay).dropDuplicatesWithinWatermark(list(LINE_KEY))
    _run(spark, fresh.writeStream.format("parquet").option("path", store.path("sales")),
         store.path("checkpoints/keys"))


def outcomes(spark: SparkSession, out: str) -> DataFrame:
    """(raw columns, failed_checks, copies) of every delivered line; '' marks the lines kept.

    Only candidates that may be lost are shuffled with their cells. Candidates that were not kept broke the unique key if it is in the store, else they came
    too late. Copies sum to the lines delivered.
    """
    store = Deduplicated(out)
    sales = spark.read.schema(_KEPT).parquet(store.path("sales"))
    candidates = spark.read.schema(_CANDIDATE).parquet(store.path("candidates"))
    # The lines kept are candidates, and a batch has a key once, so a digest with more
    # candidates than lines kept has a lost one, whichever keys meet in it.
    digest = F.xxhash64(*LINE_KEY)
    counted = candidates.select(BATCH, digest.alias("digest"), F.lit(1).alias("n")).unionByName(
        sales.select(BATCH, digest.alias("digest"), F.lit(-1).alias("n")))
    path = scratch_path(spark, "lost_lines")
    counted.groupBy("digest", BATCH).agg(F.sum("n").alias("n")).filter("n > 0").select(
        "digest").write.parquet(path)
    digests = spark.read.schema("digest bigint").parquet(path)
    near = maybe_among(sales.select(BATCH, *LINE_KEY), digest, digests)
    # Not an anti-join, which the optimizer would move below the one with the bitmap.
    lost = maybe_among(candidates, digest, digests).join(
        near.withColumn("kept", F.lit(True)), [BATCH, *LINE_KEY], "left").filter("kept is null")
    known = near.select(*LINE_KEY, F.lit(True).alias("known")).distinct()
    lost = lost.join(known, list(LINE_KEY), "left").withColumn(
        "failed_checks", F.when(F.col("known"), F.lit(UNIQUE_LINE)).otherwise(F.lit(LATE_LINE)))
    one = F.lit(1).cast("bigint").alias("copies")
    rejected = spark.read.parquet(store.path("rejected"))
    return (
        sales.select(*RAW_COLUMNS, F.lit("").alias("failed_checks"), one)
        .unionByName(lost.select(*RAW_COLUMNS, "failed_checks", one))
        .unionByName(rejected.select(*RAW_COLUMNS, "failed_checks", "copies"))
    )


def flag_receipts(
    raw: DataFrame, out: str, limit: int = fixed.RECEIPT_REPEAT_LIMIT
) -> None:
    """Findings of receipts with more than ``limit`` lines, in the batch that takes them over it.

    The lines of a receipt in one store and sheet are counted over all batches in the
    state of a streaming aggregation, pre-aggregated before its shuffle. A batch gives
    the counts that it changed; those over the limit are findings unless an earlier batch
    found them, so a receipt is found once however many lines follow.
    """
    key = ["store_id", "source_sheet", "receipt_no"]
    counts = raw.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"))

    def find(batch: DataFrame, batch_id: int) -> None:
        found = receipt_findings(batch.filter(F.col("lines") > limit))
        if batch_id:
            # Only earlier batches count, so that a repeated batch finds the same again.
            earlier = found_receipts(batch.sparkSession, out, found).filter(
                F.col(BATCH) < batch_id)
            found = found.join(
                earlier.select(*[F.col(c).alias(f"known_{c}") for c in found.columns]),
                _same(found.columns), "left_anti")
        found.write.mode("overwrite").parquet(f"{out}/found/{BATCH}={batch_id}")

    _run(raw.sparkSession, counts.writeStream.outputMode("update").foreachBatch(find),
         f"{out}/checkpoints/counts")


def _same(columns: list[str]):
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"known_{c}"))
    return same


def found_receipts(spark: SparkSession, out: str, like: DataFrame | None = None) -> DataFrame:
    """The findings of all batches with the number of their batch."""
    reader = spark.read
    if like is not None:
        reader = reader.schema(T.StructType([*like.schema, T.StructField(BATCH, T.LongType())]))
    return reader.parquet(f"{out}/found")


def flagged_so_far(spark: SparkSession, out: str) -> DataFrame:
    """Receipt numbers found in any store so far."""
    return flagged_receipts(found_receipts(spark, out))


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in ``STATE_STORE``, but for what the session sets."""
    names = {f"spark.sql.streaming.stateStore.{k}": v for k, v in STATE_STORE.items()}
    added = [name for name in names if spark.conf.get(name, None) is None]
    for name in added:
        spark.conf.set(name, names[name])
    try:
        yield
    finally:
        for name in added:
            spark.conf.unset(name)


def _run(spark: SparkSession, writer, checkpoint: str) -> None:
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with _state_store(spark):
        stream = writer.start()
    stream.awaitTermination()
