"""Run metrics as a table."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

METRICS_SCHEMA = "run_id string, step int, table_name string, rows bigint, seconds double"


@dataclass
class Written:
    rows: int = 0


class RunMetrics:
    """Rows and seconds of every table written, kept for the final summary.

    Tables may be written side by side, so seconds overlap.
    """

    def __init__(self, spark: SparkSession, run_id: str) -> None:
        self.spark = spark
        self.run_id = run_id
        self.rows: list[tuple[str, int, str, int, float]] = []

    @contextmanager
    def table(self, step: int, name: str) -> Iterator[Written]:
        written, started = Written(), time.monotonic()
        yield written
        self.add(step, name, written.rows, round(time.monotonic() - started, 3))

    def add(self, step: int, name: str, rows: int, seconds: float = 0.0) -> None:
        self.rows.append((self.run_id, step, name, rows, seconds))

    def rows_of(self, table: str) -> int:
        return next(row[3] for row in self.rows if row[2] == table)

    def summary(self) -> dict[str, int]:
        """Totals of the run: sales lines, staged rows, findings, fact rows, customers."""
        staged = sum(row[3] for row in self.rows
                     if row[2].startswith("staging.") and not row[2].endswith("_rejected"))
        return {
            "raw.transactions": self.rows_of("raw.transactions"),
            "staging tables": staged,
            "audit findings": self.rows_of("audit.validation_log"),
            "fact_transactions": self.rows_of("marts.fact_transactions"),
            "dim_customers": self.rows_of("marts.dim_customers"),
        }

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, METRICS_SCHEMA)

    def append_to(self, path: str) -> None:
        self.frame().coalesce(1).write.mode("append").parquet(path)
