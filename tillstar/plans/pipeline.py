"""The full refresh, published as one unit.

Its steps: 1 masters, 2 sales, 3 staging, 4 validation, 5 dimensions, 6 fact,
7 customers, 8 integrity.

Each layer is written once and read back by the next steps, so raw parsing and
matching are never recomputed, and a lost executor repeats only its own tasks.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.config import WarehouseConfig
from tillstar.operators import constraints, masters
from tillstar.operators.customers import customer_visits
from tillstar.operators.dimensions import (
    DIMENSIONS,
    append_dates,
    build_dim_date,
    date_spine,
)
from tillstar.operators.fact import Dimensions, build_fact, trace_lines
from tillstar.operators.integrity import (
    OUTCOMES,
    observed_fact,
    orphan_counts,
    row_outcomes,
)
from tillstar.operators.keys import with_dense_key
from tillstar.operators.sales import line_findings, split_sales
from tillstar.operators.validation import findings_per_check, flagged_receipts, validation_log
from tillstar.plans.gate import quality_gate
from tillstar.plans.metrics import RunMetrics
from tillstar.sources.landed import (
    Source,
    default_sources,
    read_masters,
    read_sales,
    registry_frame,
    source_row_counts,
)
from tillstar.sources.layers import Layers, Run, in_months

log = logging.getLogger("tillstar")

MASTERS = ("products", "staff", "managers", "stores")


@dataclass(frozen=True)
class RunResult:
    run: Run
    metrics: RunMetrics
    findings: Mapping[str, int]
    orphans: Mapping[str, int]
    outcomes: Mapping[str, int]


def run_landed(
    spark: SparkSession,
    landing: str,
    root: str,
    config: WarehouseConfig = WarehouseConfig(),
    sources: list[Source] | None = None,
) -> RunResult:
    """Full refresh from landed files: ``<landing>/sales/<sheet>/`` and ``<landing>/masters/``."""
    raw = dict(read_masters(spark, f"{landing}/masters"))
    sources = sources or default_sources()
    raw["transactions"] = read_sales(spark, f"{landing}/sales", sources)
    return run_pipeline(spark, raw, root, config, sources)


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    config: WarehouseConfig = WarehouseConfig(),
    sources: Sequence[Source] = (),
) -> RunResult:
    """Full refresh from raw text tables ``transactions`` and the four masters.

    The lines of each of the ``sources`` are counted in the run's metrics, zeros too.
    """
    return _Refresh(spark, raw, root, config, sources).run_all()


class _Refresh:
    """One run: its layers, and the tables written so far."""

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], root: str,
        config: WarehouseConfig, sources: Sequence[Source] = (),
    ) -> None:
        self.spark, self.raw, self.config, self.sources = spark, raw, config, sources
        self.layers = Layers(spark, root)
        self.previous = self.layers.published()
        self.run = self.layers.new_run()
        self.metrics = RunMetrics(spark, self.run.run_id)
        self.observed = Observation("outcomes")

    def run_all(self) -> RunResult:
        """Steps that do not need each other run side by side, so that small tables
        fill the cluster beside the big ones."""
        _together(
            self.load_sales,
            *[partial(self.load_master, name) for name in MASTERS],
        )
        findings = _together(
            self.validate,
            self.stage_sales,
            *[partial(self.stage_master, name) for name in MASTERS],
            self.build_calendar,
        )[0]
        _ = self.flagged  # written once, before the steps that read it side by side
        _together(self.build_fact, self.log_constraints)
        orphans, outcomes, _ = _together(
            self.check_orphans, self.account_rows, self.build_customers)
        if outcomes:
            _check_accounts(self.metrics, outcomes)
        self.layers.publish(self.run)
        self.metrics.append_to(f"{self.layers.root}/metrics")
        return RunResult(
            self.run, self.metrics, findings, orphans,
            {outcome: rows for outcome, (rows, _) in outcomes.items()},
        )

    def table(self, name: str) -> DataFrame:
        return self.layers.read(name, self.run)

    def write(self, step: int, table: str, df: DataFrame) -> None:
        with self.metrics.table(step, table) as written:
            written.rows = self.layers.write(self.run, table, df)

    def write_keyed(
        self, step: int, table: str, df: DataFrame, key: str, order: Sequence[str] = (),
    ) -> None:
        with self.metrics.table(step, table) as written:
            keyed = with_dense_key(df, key, self.run.stage_path(table), order)
            written.rows = self.layers.write(self.run, table, keyed)

    @cached_property
    def dims(self) -> Dimensions:
        return Dimensions(*[
            self.table(f"marts.dim_{name}") for name in ("stores", "staff", "products", "date")
        ])

    @cached_property
    def flagged(self) -> DataFrame:
        """Stored, so that its size is known and a hot receipt's lines can be split in the join."""
        path = self.run.stage_path("flagged_receipts")
        flagged_receipts(self.table("audit.validation_log")).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def load_master(self, name: str) -> None:
        table, df = f"raw.{name}", self.raw[name]
        if self.previous is not None and df.isEmpty():
            df = self.layers.read(table, self.previous)  # an empty list keeps the last load
        self.write(1, table, df)

    def load_sales(self) -> None:
        self.write(2, "raw.transactions", self.raw["transactions"])
        if self.sources:
            counts = source_row_counts(
                self.table("raw.transactions"), registry_frame(self.spark, self.sources))
            for r in counts.orderBy("sheet_name").collect():
                self.metrics.add(2, f"raw.transactions/{r['sheet_name']}", r["row_count"])
                if not r["row_count"]:
                    log.warning("source %s delivered no line", r["sheet_name"])

    def stage_master(self, name: str) -> None:
        """The typed master and, right after it, its dimension."""
        table = f"staging.{name}"
        typed = constraints.enforce(
            masters.STAGERS[name](self.table(f"raw.{name}")), table, masters.master_checks(name),
            [masters.PRIMARY_KEYS[name]], self.config.constraint_policy,
            self.run.stage_path(table))
        self.write(3, table, typed)
        key, order, columns = DIMENSIONS[name]
        self.write_keyed(
            5, f"marts.dim_{name}", self.table(table).select(*columns), key, [order])

    def stage_sales(self) -> None:
        split = split_sales(
            self.table("raw.transactions"), self.run.stage_path("repeated_lines"))
        ids = F.monotonically_increasing_id() + 1
        kept = split.kept.withColumn("transaction_id", ids)
        _together(
            partial(self.write, 3, "staging.transactions", kept),
            partial(self.write, 3, "staging.transactions_rejected", split.rejected),
        )

    def log_constraints(self) -> None:
        broken = [
            _master_findings(name, masters.STAGERS[name](self.table(f"raw.{name}")))
            for name in MASTERS
        ]
        lines = line_findings(self.table("staging.transactions_rejected"))
        self.write(3, "audit.constraint_log", reduce(DataFrame.unionByName, broken, lines))

    def validate(self) -> dict[str, int]:
        checked = validation_log(
            self.table("raw.transactions"), self.table("raw.products"), self.table("raw.staff"),
            self.config.receipt_repeat_limit)
        self.write_keyed(4, "audit.validation_log", checked, "log_id")
        per_check = findings_per_check(self.table("audit.validation_log")).collect()
        findings = {r["check_name"]: r["findings"] for r in per_check}
        quality_gate("audit findings", findings, self.config.gate_policy)
        return findings

    def build_calendar(self) -> None:
        config = self.config
        dates = build_dim_date(date_spine(self.spark, config.spine_start, config.spine_end))
        if self.previous is not None:
            dates = append_dates(self.layers.read("marts.dim_date", self.previous), dates)
        self.write(5, "marts.dim_date", dates)

    def build_fact(self) -> None:
        """The fact, clustered by month before it is numbered, and its lines' outcomes."""
        table, by_month = "marts.fact_transactions", self.config.partition_fact_by_month
        sales = self.table("staging.transactions")
        if self.config.account_rows:
            rows = observed_fact(trace_lines(sales, self.dims, self.flagged), self.observed)
        else:
            rows = build_fact(sales, self.dims, self.flagged)
        with self.metrics.table(6, table) as written:
            if by_month:
                rows = in_months(rows, "transaction_date")
            keyed = with_dense_key(rows, "transaction_key", self.run.stage_path(table))
            written.rows = self.layers.write(
                self.run, table, keyed, "transaction_date" if by_month else None, clustered=True)

    def build_customers(self) -> None:
        self.write_keyed(
            7, "marts.dim_customers", customer_visits(self.table("marts.fact_transactions")),
            "customer_key", ["customer_phone"])

    def check_orphans(self) -> dict[str, int]:
        counts = orphan_counts(self.table("marts.fact_transactions"), {
            "store_key": self.dims.stores, "staff_key": self.dims.staff,
            "product_key": self.dims.products, "date_key": self.dims.dates,
        }).collect()
        orphans = {r["check_name"]: r["orphan_count"] for r in counts}
        quality_gate("orphans", orphans, self.config.gate_policy)
        return orphans

    def account_rows(self) -> dict[str, tuple[int, int]]:
        """(sales lines, promised fact rows) per outcome, as observed while the fact was written.

        If they do not add up to the lines loaded and the rows written, because tasks ran
        twice or rows are missing, the lines are counted again one by one.
        """
        if not self.config.account_rows:
            return {}
        seen = self.observed.get
        broken = self.table("staging.transactions_rejected").agg(F.sum("copies")).head()[0] or 0
        outcomes = {o: (seen[o], 0) for o in OUTCOMES[1:]} | {"quarantined": (broken, 0)}
        outcomes["in_fact"] = (seen["in_fact"], seen["fact_rows"])
        try:
            _check_accounts(self.metrics, outcomes)
        except RowAccountError as error:
            log.warning("counting the lines again: %s", error)
            rows = row_outcomes(
                self.table("staging.transactions"), self.table("staging.transactions_rejected"),
                self.flagged, self.dims, self.run.stage_path("outcome_lookups"),
            ).collect()
            outcomes = {r["outcome"]: (r["source_rows"], r["fact_rows"]) for r in rows}
        return outcomes


class RowAccountError(RuntimeError):
    """Sales lines were lost or invented on the way to the fact."""


def _check_accounts(metrics: RunMetrics, outcomes: Mapping[str, tuple[int, int]]) -> None:
    """Every raw line has one outcome, and the fact holds what the outcomes promise."""
    raw_rows = metrics.rows_of("raw.transactions")
    fact_rows = metrics.rows_of("marts.fact_transactions")
    accounted = sum(rows for rows, _ in outcomes.values())
    promised = sum(rows for _, rows in outcomes.values())
    if accounted != raw_rows:
        raise RowAccountError(f"outcomes {dict(outcomes)} do not sum to {raw_rows} raw lines")
    if promised != fact_rows:
        raise RowAccountError(f"{promised} fact rows expected, {fact_rows} written")


def _master_findings(name: str, typed: DataFrame) -> DataFrame:
    """Audit rows for the broken constraints of a master list."""
    key = masters.PRIMARY_KEYS[name]
    store = F.col("store_id") if "store_id" in typed.columns else F.lit(None).cast("string")
    broken = constraints.violations(
        typed.withColumn("at_store", store), masters.master_checks(name), ["at_store"]
    ).withColumn("copies", F.lit(1).cast("bigint"))
    repeated = constraints.repeated_keys(typed, [key]).select(
        F.lit(None).cast("string").alias("at_store"),
        F.lit(f"{key}_unique").alias("check_name"),
        F.col(key).alias("raw_value"),
        (F.col("copies") - 1).alias("copies"),
    )
    return broken.unionByName(repeated).select(
        F.lit(f"staging.{name}").alias("table_name"), "check_name",
        F.col("at_store").alias("store_id"), F.lit(None).cast("string").alias("source_sheet"),
        "raw_value", "copies",
    )


def _together(*jobs: Callable[[], object]) -> list:
    """The results of jobs that run side by side; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]
