"""Stored layers: every run writes its own folder and is published as one unit.

A run that fails leaves the published tables as they were. Publishing appends
one row to a small log; readers take the run of the latest row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.schemas import SCHEMAS, conform

MONTH = "sale_month"


def in_months(df: DataFrame, stamp: str) -> DataFrame:
    """``df`` dealt out by the month of ``stamp``.

    The rebalance splits months that are too big for one task and packs small ones.
    """
    month = F.date_format(stamp, "yyyy-MM").alias(MONTH)
    return df.select("*", month).hint("rebalance", MONTH).drop(MONTH)


@dataclass(frozen=True)
class Run:
    run_id: str
    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder}/{table.replace('.', '/')}"

    def stage_path(self, table: str) -> str:
        return f"{self.folder}/_stage/{table.replace('.', '/')}"


class Layers:
    """The tables under one root folder, which all executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def new_run(self) -> Run:
        now = datetime.now(timezone.utc)
        return self._run(f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")

    def _run(self, run_id: str) -> Run:
        return Run(run_id, f"{self.root}/runs/{run_id}")

    def publish(self, run: Run) -> None:
        row = [(run.run_id, datetime.now(timezone.utc).replace(tzinfo=None))]
        log = self.spark.createDataFrame(row, "run_id string, published_at timestamp_ntz")
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/published")

    def published(self) -> Run | None:
        try:
            log = self.spark.read.parquet(f"{self.root}/published")
        except AnalysisException:
            return None
        latest = log.agg(F.max_by("run_id", "published_at")).head()
        return self._run(latest[0])

    def write(
        self, run: Run, table: str, df: DataFrame, by_month: str | None = None,
        clustered: bool = False,
    ) -> int:
        """Write ``df`` in the schema of ``table``; gives the rows written.

        Rows are counted in the written files' footers, so a task repeated after
        a lost executor is not counted twice. ``by_month`` names a timestamp
        column to partition by month; see ``in_months``, which is left out if ``df`` is
        ``clustered`` like that already.
        """
        shaped = conform(df, table)
        if by_month and not clustered:
            shaped = in_months(shaped, by_month)
        if by_month:
            shaped = shaped.withColumn(MONTH, F.date_format(by_month, "yyyy-MM"))
            shaped.write.mode("overwrite").partitionBy(MONTH).parquet(run.path(table))
        else:
            shaped.write.mode("overwrite").parquet(run.path(table))
        return self.spark.read.schema(SCHEMAS[table]).parquet(run.path(table)).count()

    def read(self, table: str, run: Run | None = None) -> DataFrame:
        """A table of ``run``, or of the published run."""
        return self._stored(table, run, SCHEMAS[table]).select(*SCHEMAS[table].names)

    def read_by_month(self, table: str, run: Run | None = None) -> DataFrame:
        """Like ``read`` for a table partitioned by month, with its month column."""
        month = T.StructField(MONTH, T.StringType())
        return self._stored(table, run, T.StructType([*SCHEMAS[table], month]))

    def _stored(self, table: str, run: Run | None, schema: T.StructType) -> DataFrame:
        run = run or self.published()
        if run is None:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return self.spark.read.schema(schema).parquet(run.path(table))
