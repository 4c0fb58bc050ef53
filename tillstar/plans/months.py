"""Deliveries added to a fact that is kept by month: only touched months are built again.

Every delivery is a load. Its lines, receipt counts, masters and rebuilt months go to
folders of their own; one appended row then publishes the load together with the map
of the months to the loads that hold them. Readers see the old map or the new one,
files of other months are neither read nor written, and a load that fails leaves no
trace but its folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import fixed_values as fixed
from tillstar.functions import norm_key, trimmed
from tillstar.operators.dimensions import append_dates, current_rows, extend_dimension
from tillstar.operators.fact import Dimensions, build_fact
from tillstar.operators.keys import with_dense_key
from tillstar.operators.sales import LINE_KEY, UNIQUE_LINE, split_sales
from tillstar.sources.layers import MONTH

#: Masters that sales are matched with.
MATCHED = ("stores", "staff", "products")
_LOG = ("number bigint, load string, published_at timestamp_ntz, last_key bigint,"
        " months map<string,string>")


@dataclass(frozen=True)
class Load:
    """A published state: the loads so far and the load that holds each month."""

    number: int = 0
    load: str = ""
    last_key: int = 0
    loads: tuple[str, ...] = ()
    months: Mapping[str, str] = field(default_factory=dict)


class MonthlySales:
    """Sales, masters and fact under one root folder, which all executors share."""

    def __init__(
        self, spark: SparkSession, root: str, receipt_limit: int = fixed.RECEIPT_REPEAT_LIMIT
    ) -> None:
        self.spark, self.root, self.receipt_limit = spark, root.rstrip("/"), receipt_limit

    def published(self) -> Load:
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.root}/published")
        except AnalysisException:
            return Load()
        rows = sorted(log.collect(), key=lambda r: r["number"])
        if not rows:
            return Load()
        last = rows[-1]
        return Load(last["number"], last["load"], last["last_key"],
                    tuple(r["load"] for r in rows), last["months"])

    def fact(self, state: Load | None = None) -> DataFrame:
        """The fact with its month column; a filter on the month prunes folders."""
        state = state or self.published()
        if not state.months:
            raise FileNotFoundError(f"no month is published under {self.root}")
        some = self.spark.read.parquet(self._path("fact", next(iter(state.months.values()))))
        text = [T.StructField(c, T.StringType()) for c in (MONTH, "load")]
        schema = T.StructType([*[f for f in some.schema if f.name != MONTH], *text])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/fact")
        held: dict[str, list[str]] = {}
        for month, load in state.months.items():
            held.setdefault(load, []).append(month)
        mine = [(F.col("load") == load) & F.col(MONTH).isin(months)
                for load, months in held.items()]
        return rows.filter(reduce(or_, mine)).drop("load")

    def dimension(self, name: str, state: Load | None = None) -> DataFrame:
        """All keys given out so far; ``dates`` is the calendar."""
        return self._read("dims", name, state or self.published())

    def _path(self, part: str, load: str) -> str:
        return f"{self.root}/{part}/load={load}"

    def _read(self, kind: str, name: str, state: Load) -> DataFrame:
        return self.spark.read.parquet(self._path(f"{kind}/{name}", state.load))

    def _written(self, df: DataFrame, part: str, load: str, by_month: bool = False) -> DataFrame:
        writer = df.write.mode("overwrite")
        if by_month:
            writer = df.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
        writer.parquet(self._path(part, load))
        schema = T.StructType([f for f in df.schema if f.name != MONTH] + [
            f for f in df.schema if f.name == MONTH]) if by_month else df.schema
        return self.spark.read.schema(schema).parquet(self._path(part, load))

    def _of_loads(self, part: str, loads: tuple[str, ...], like: DataFrame) -> DataFrame:
        """The rows of a part in published loads."""
        schema = T.StructType([*like.schema, T.StructField("load", T.StringType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{part}")
        return rows.filter(F.col("load").isin(list(loads))).drop("load")

    def add(
        self, raw: DataFrame, masters: Mapping[str, DataFrame], dates: DataFrame
    ) -> tuple[Load, list[str]]:
        """Add a delivery of raw lines under the typed ``masters`` and calendar of today.

        A line is a reject if an earlier load kept its (receipt, product). Months are
        built again if they have new lines, lines of a receipt that is flagged from
        now on, lines of a master that was added, dropped or changed, or new days. Gives
        the published state and the months built again, which are all that the driver
        sees beside one row per load.
        """
        before = self.published()
        load = f"{before.number + 1:06d}-{uuid.uuid4().hex[:8]}"
        loads = (*before.loads, load)
        sales, fresh = self._add_lines(raw, before, load)
        flagged, newly = self._flag(raw, before, load)
        dims, changed = self._masters(masters, dates, before, load)
        lines_of = [fresh.select(MONTH)]
        if before.loads:
            lines_of.append(sales.join(newly, "receipt_no", "left_semi").select(MONTH))
            lines_of += [sales.join(names, same, "left_semi").select(MONTH)
                         for names, same in changed]
        touched = sorted(r[0] for r in reduce(
            DataFrame.unionByName, lines_of).distinct().collect())
        rows = build_fact(sales.filter(F.col(MONTH).isin(touched)).drop(MONTH), dims, flagged)
        keyed = with_dense_key(rows, "transaction_key", f"{self.root}/stage/{load}/fact").select(
            (F.col("transaction_key") + before.last_key).alias("transaction_key"),
            *rows.columns, F.date_format("transaction_date", "yyyy-MM").alias(MONTH))
        written = self._written(keyed, "fact", load, by_month=True)
        counted = written.groupBy(MONTH).agg(F.max("transaction_key").alias("last")).collect()
        months = {m: at for m, at in before.months.items() if m not in touched}
        months |= {r[MONTH]: load for r in counted}
        state = Load(before.number + 1, load,
                     max([before.last_key, *[r["last"] for r in counted]]), loads, months)
        self._publish(state)
        return state, touched

    def _publish(self, state: Load) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        row = [(state.number, state.load, now, state.last_key, dict(state.months))]
        self.spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").parquet(
            f"{self.root}/published")

    def _add_lines(self, raw: DataFrame, before: Load, load: str) -> tuple[DataFrame, DataFrame]:
        """All kept lines with this load's, and this load's."""
        split = split_sales(raw, f"{self.root}/stage/{load}/repeated")
        kept, rejected = split.kept, split.rejected
        if before.loads:
            keys = list(LINE_KEY)
            known = self._of_loads("sales", before.loads, kept.withColumn(MONTH, F.lit(""))).select(
                *keys)
            again = split.lines.join(known, keys, "left_semi")
            rejected = rejected.unionByName(again.select(
                "*", F.lit(UNIQUE_LINE).alias("failed_checks"),
                F.lit(1).cast("bigint").alias("copies")))
            kept = kept.join(known, keys, "left_anti").select(*kept.columns)
        self._written(rejected, "rejected", load)
        monthly = kept.withColumn(MONTH, F.date_format("transaction_date", "yyyy-MM"))
        fresh = self._written(monthly, "sales", load, by_month=True)
        return self._of_loads("sales", (*before.loads, load), fresh), fresh

    def _flag(self, raw: DataFrame, before: Load, load: str) -> tuple[DataFrame, DataFrame]:
        """Receipts flagged up to this load, and those that it flags.

        Lines are counted once per load; earlier counts are read for the receipts of this
        load only.
        """
        key = ["store_id", "source_sheet", "receipt_no"]
        counts = self._written(
            raw.groupBy(*key).agg(F.count(F.lit(1)).alias("lines")), "receipts", load)
        over = counts
        if before.loads:
            earlier = self._of_loads("receipts", before.loads, counts)
            mine = counts.select("receipt_no").distinct()
            over = earlier.join(mine, "receipt_no", "left_semi").unionByName(counts)
        found = over.groupBy(*key).agg(F.sum("lines").alias("lines")).filter(
            F.col("lines") > self.receipt_limit).select("receipt_no").filter(
            F.col("receipt_no").isNotNull()).distinct()
        if not before.loads:
            flagged = self._written(found, "flagged", load)
            return flagged, flagged
        known = self._of_loads("flagged", before.loads, found)
        newly = self._written(found.join(known, "receipt_no", "left_anti"), "flagged", load)
        return self._of_loads("flagged", (*before.loads, load), newly), newly

    def _masters(
        self, masters: Mapping[str, DataFrame], dates: DataFrame, before: Load, load: str
    ) -> tuple[Dimensions, list[tuple[DataFrame, Column]]]:
        """The dimensions for matching, and the changed masters with how lines meet them."""
        current, changed = {}, []
        for name in MATCHED:
            known = self._read("dims", name, before) if before.loads else None
            staged = self._written(masters[name], f"masters/{name}", load)
            dimension = self._written(extend_dimension(
                name, known, staged, f"{self.root}/stage/{load}/{name}"), f"dims/{name}", load)
            current[name] = current_rows(name, dimension, staged)
            if before.loads:
                was = self._read("masters", name, before)
                differ = was.exceptAll(staged).unionByName(staged.exceptAll(was))
                changed.append(_met_by_lines(name, differ))
        if before.loads:
            was = self._read("dims", "dates", before)
            dates = append_dates(was, dates)
            days = dates.join(was, "full_date", "left_anti").select(
                F.date_format("full_date", "yyyy-MM").alias("new_month")).distinct()
            changed.append((days, F.col(MONTH) == F.col("new_month")))
        dates = self._written(dates, "dims/dates", load)
        return Dimensions(current["stores"], current["staff"], current["products"], dates), changed


def _met_by_lines(name: str, differ: DataFrame) -> tuple[DataFrame, Column]:
    if name == "stores":
        return (differ.select(trimmed("store_id").alias("m_store")).distinct(),
                trimmed("store_id") == F.col("m_store"))
    if name == "products":
        return (differ.select(norm_key("product_name").alias("m_name")).distinct(),
                norm_key("product_sold") == F.col("m_name"))
    return (differ.select(norm_key("full_name").alias("m_name"),
                          trimmed("store_id").alias("m_store")).distinct(),
            (norm_key("staff_name") == F.col("m_name"))
            & (trimmed("store_id") == F.col("m_store")))
