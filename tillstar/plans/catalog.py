"""The registered queries: each operator over the star-schema test tables.

A query starts from the given tables. Repeated lines, lookups of hot keys,
surrogate keys and streams are written to the shared scratch folder on the way,
so those queries run jobs while they are built.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import fixed_values as fixed
from tillstar import functions as fx
from tillstar.operators import constraints as c
from tillstar.operators import customers, dimensions, fact, integrity, masters, reports
from tillstar.operators import sales as sales_ops
from tillstar.operators import validation
from tillstar.config import WarehouseConfig
from tillstar.operators.keys import with_dense_key
from tillstar.plans.months import MATCHED, Load, MonthlySales
from tillstar.plans.pipeline import MASTERS, run_pipeline
from tillstar.plans.visits import MonthlyVisits
from tillstar.session import scratch_path
from tillstar.sources import landed, receipts, star_tables
from tillstar.sources.layers import Layers
from tillstar.streaming import ingest, state

PRODUCT_TERM = "ring"
WEEK_START = date(1998, 3, 2)


class RetailTables:
    """Lazily composed frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._landed = False

    def table(self, name: str) -> DataFrame:
        return star_tables.read_table(self.spark, self.folder, name)

    def raw(self, name: str) -> DataFrame:
        return star_tables.raw_frame(self.spark, self.folder, f"raw_{name}")

    @cached_property
    def sales(self) -> DataFrame:
        return self.raw("transactions")

    def land(self) -> None:
        """Writes the raw sales once, so that what reads them again does not join them again.

        A fact reads them four times: for the digests of its keys, the repeated lines, the
        receipts with too many lines and the lines kept.
        """
        if self._landed:
            return
        path = scratch_path(self.spark, "raw_sales")
        raw = self.sales
        raw.write.parquet(path)
        self.sales = self.spark.read.schema(raw.schema).parquet(path)
        self._landed = True

    @cached_property
    def split(self) -> sales_ops.SalesSplit:
        return sales_ops.split_sales(self.sales, scratch_path(self.spark, "repeated_lines"))

    def staged(self, name: str) -> DataFrame:
        return masters.STAGERS[name](self.raw(name))

    @cached_property
    def duplicates(self) -> DataFrame:
        return validation.duplicate_receipts(self.sales)

    @cached_property
    def flagged(self) -> DataFrame:
        """Stored first, so that the planner knows its size when it picks the anti-join."""
        path = scratch_path(self.spark, "flagged_receipts")
        validation.flagged_receipts(self.duplicates).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def log(self) -> DataFrame:
        return validation.validation_log(self.sales, self.raw("products"), self.raw("staff"))

    @cached_property
    def registry(self) -> DataFrame:
        """One sales source per nation, and one that never delivers."""
        nations = self.table("nation")
        store_id = F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
        absent = nations.agg(
            F.concat(F.lit("S9"), F.lpad(F.count(F.lit(1)).cast("string"), 2, "0"))
            .alias("store_id")
        )
        return nations.select(store_id.alias("store_id")).unionByName(absent).withColumn(
            "sheet_name", F.concat(F.lit("SalesLog_"), F.col("store_id"))
        )

    def dimension(self, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"dim_{name}")
        return dimensions.build_dimension(name, self.staged(name), path)

    @cached_property
    def dates(self) -> DataFrame:
        return dimensions.build_dim_date(
            dimensions.spine_of_years(self.table("orders"), "o_orderdate"))

    @cached_property
    def dims(self) -> fact.Dimensions:
        return fact.Dimensions(
            self.dimension("stores"), self.dimension("staff"), self.dimension("products"),
            self.dates,
        )

    @cached_property
    def keyless_dims(self) -> fact.Dimensions:
        """Dimensions for results without surrogate keys: nothing has to be staged."""
        def with_null_key(name: str) -> DataFrame:
            key = dimensions.DIMENSIONS[name][0]
            return self.staged(name).withColumn(key, F.lit(None).cast("bigint"))

        return fact.Dimensions(
            with_null_key("stores"), with_null_key("staff"), with_null_key("products"),
            self.dates,
        )

    @cached_property
    def fact(self) -> DataFrame:
        self.land()
        return fact.build_fact(self.split.kept, self.dims, self.flagged)

    @cached_property
    def keyless_fact(self) -> DataFrame:
        self.land()
        return fact.build_fact(self.split.kept, self.keyless_dims, self.flagged)

    @cached_property
    def parsed_sales(self) -> DataFrame:
        return self.sales.select(
            "*",
            fx.parse_timestamp("timestamp").alias("transaction_date"),
            fx.parse_count("quantity").alias("units"),
        )


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[RetailTables], DataFrame]) -> Callable[[RetailTables], DataFrame]:
    """Register ``build`` under its name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(RetailTables(spark, folder))

    QUERIES[build.__name__] = run
    return build


def _rows(alias: str = "rows"):
    return F.count(F.lit(1)).alias(alias)


# Sources

@query
def raw_transactions(t: RetailTables) -> DataFrame:
    return t.sales


@query
def raw_products(t: RetailTables) -> DataFrame:
    return landed.fill_missing(t.raw("products"), fixed.MASTER_COLUMNS["products"])


@query
def raw_staff(t: RetailTables) -> DataFrame:
    return landed.fill_missing(t.raw("staff"), fixed.MASTER_COLUMNS["staff"])


@query
def raw_managers(t: RetailTables) -> DataFrame:
    return landed.fill_missing(t.raw("managers"), fixed.MASTER_COLUMNS["managers"])


@query
def raw_stores(t: RetailTables) -> DataFrame:
    return landed.fill_missing(t.raw("stores"), fixed.MASTER_COLUMNS["stores"])


@query
def raw_default_fill(t: RetailTables) -> DataFrame:
    """Sheets with NULL cells, a missing column and an extra one."""
    sheet = t.sales.select(
        "timestamp", "staff_name", "receipt_no", "product_sold", "quantity",
        F.nullif("customer_phone", F.lit("")).alias("customer_phone"),
        F.col("store_id").alias("till_number"),
    )
    return landed.fill_missing(sheet, fixed.SALES_SHEET_COLUMNS)


@query
def raw_stamp_source(t: RetailTables) -> DataFrame:
    """Store and sheet by folder; the sheet's own store id is wrong and ignored."""
    read = t.sales.select(
        "receipt_no", "product_sold",
        F.lit("S000").alias("store_id"),
        F.concat(F.lit("landing/sales/"), F.col("source_sheet"), F.lit("/part-0.csv"))
        .alias("source_path"),
    )
    return landed.stamp_source(read, t.registry)


@query
def source_row_counts(t: RetailTables) -> DataFrame:
    return landed.source_row_counts(t.sales, t.registry)


@query
def landed_sales(t: RetailTables) -> DataFrame:
    """All sheets of all stores, landed as files and read back."""
    root = scratch_path(t.spark, "landing")
    sources = star_tables.land_sheets(t.spark, t.folder, root)
    return landed.read_sales(t.spark, f"{root}/sales", sources)


@query
def landed_source_counts(t: RetailTables) -> DataFrame:
    """Lines per landed source, with a sheet of a header only and one that never came."""
    root = scratch_path(t.spark, "landing")
    sources = star_tables.land_sheets(t.spark, t.folder, root)
    return landed.source_row_counts(
        landed.read_sales(t.spark, f"{root}/sales", sources),
        landed.registry_frame(t.spark, sources))


@query
def landed_masters(t: RetailTables) -> DataFrame:
    """The four landed master lists: each row's id and the digest of all its cells."""
    root = scratch_path(t.spark, "landing_masters")
    star_tables.land_masters(t.spark, t.folder, root)
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("list_name"), F.col(rows.columns[0]).alias("row_id"),
                    F.md5(F.concat_ws("|", *rows.columns)).alias("cells_md5"))
        for name, rows in landed.read_masters(t.spark, root).items()])


@query
def dim_date_upsert(t: RetailTables) -> DataFrame:
    """A calendar that ends three years before the last sale, extended to all years of the orders."""
    orders = t.table("orders")
    wanted = dimensions.build_dim_date(
        dimensions.spine_of_years(orders, "o_orderdate"))
    cut = orders.agg(F.add_months(F.trunc(F.max("o_orderdate"), "year"), -36)).scalar()
    return dimensions.append_dates(wanted.filter(F.col("full_date") < cut), wanted)


# Cleaning and typing

@query
def blank_to_null(t: RetailTables) -> DataFrame:
    return t.sales.select("receipt_no", fx.blank_to_null("customer_phone").alias("customer_phone"))


@query
def filter_blank_key(t: RetailTables) -> DataFrame:
    """Product cells of sales lines that are neither NULL nor empty."""
    return t.sales.filter(masters.filled("product_sold")).select("receipt_no", "product_sold")


@query
def filter_domain(t: RetailTables) -> DataFrame:
    return t.raw("staff").filter(
        masters.in_list("role", fixed.STAFF_ROLES)
        & masters.in_list("employment_status", fixed.EMPLOYMENT_STATUSES)
    ).select("staff_id", fx.trimmed("role").alias("role"), "employment_status")


@query
def filter_numeric_text(t: RetailTables) -> DataFrame:
    return t.raw("products").filter(fx.is_number_text("unit_price_ghs")).select(
        "product_id", "unit_price_ghs")


@query
def serial_to_date(t: RetailTables) -> DataFrame:
    return t.raw("staff").select(
        "staff_id", "date_hired", fx.parse_serial_date("date_hired").alias("hired_on"))


@query
def price_cast(t: RetailTables) -> DataFrame:
    """List price as money text, and an eighth of it, which has to be rounded."""
    list_price = F.col("p_retailprice").cast("decimal(10,2)")
    return t.table("part").select(
        "p_partkey",
        fx.parse_price(list_price.cast("string")).alias("price"),
        fx.parse_price((list_price * F.lit(Decimal("0.125"))).cast("string")).alias("price_eighth"),
    )


@query
def stg_stores(t: RetailTables) -> DataFrame:
    return t.staged("stores")


@query
def stg_staff(t: RetailTables) -> DataFrame:
    return t.staged("staff")


@query
def stg_managers(t: RetailTables) -> DataFrame:
    return t.staged("managers")


@query
def stg_products(t: RetailTables) -> DataFrame:
    return t.staged("products")


@query
def stg_transactions(t: RetailTables) -> DataFrame:
    return t.split.kept


@query
def stg_transactions_rejected(t: RetailTables) -> DataFrame:
    return t.split.rejected


# Constraints

@query
def check_not_null(t: RetailTables) -> DataFrame:
    """Products whose price cell is no number, so that the typed price is missing."""
    typed = t.raw("products").select(
        "product_id", F.col("unit_price_ghs").alias("price_text"),
        fx.parse_price("unit_price_ghs").alias("unit_price_ghs"),
    )
    return c.violations(typed, [c.not_null("unit_price_ghs", shown="price_text")], ["product_id"])


@query
def check_range(t: RetailTables) -> DataFrame:
    checked = c.violations(
        t.parsed_sales, [c.in_range("units", *fixed.QUANTITY_RANGE)], ["store_id"])
    return checked.groupBy("store_id", "check_name", "raw_value").agg(_rows("violations"))


@query
def check_domain(t: RetailTables) -> DataFrame:
    """Unknown regions, roles, statuses and payment methods, with their row counts."""
    def broken(table: str, df: DataFrame, *checks: c.RowCheck) -> DataFrame:
        return (
            c.violations(df, checks).groupBy("check_name", "raw_value").agg(_rows("violations"))
            .select(F.lit(table).alias("table_name"), "check_name", "raw_value", "violations")
        )

    staff = t.raw("staff").withColumn("role", fx.trimmed("role"))
    managers = t.raw("managers").withColumn("role", fx.trimmed("role"))
    return (
        broken("staging.stores", t.staged("stores"), c.in_domain("region", fixed.REGIONS))
        .unionByName(broken("raw.staff", staff, c.in_domain("role", fixed.STAFF_ROLES),
                            c.in_domain("employment_status", fixed.EMPLOYMENT_STATUSES)))
        .unionByName(broken("raw.managers", managers, c.in_domain("role", fixed.MANAGER_ROLES)))
        .unionByName(broken("raw.transactions", t.sales,
                            c.in_domain("payment_method", fixed.PAYMENT_METHODS)))
    )


@query
def check_positive(t: RetailTables) -> DataFrame:
    """Account balances that are zero or negative, as the column with such values."""
    balances = t.table("customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(10,2)").alias("balance"))
    return c.violations(balances, [c.positive("balance")], ["c_custkey"])


@query
def check_unique_key(t: RetailTables) -> DataFrame:
    return c.repeated_keys(t.sales, ["receipt_no"])


@query
def check_counts(t: RetailTables) -> DataFrame:
    """Primary keys of all lists and the price above zero, before and after staging."""
    def broken(layer: str, name: str, df: DataFrame) -> DataFrame:
        key = dimensions.DIMENSIONS[name][1]
        checks = [c.positive("unit_price_ghs")] if name == "products" else []
        return c.check_counts(f"{layer}.{name}", df, key, checks)

    raw = {name: t.raw(name) for name in masters.STAGERS}
    raw["products"] = raw["products"].withColumn(
        "unit_price_ghs", fx.parse_price("unit_price_ghs"))
    return reduce(DataFrame.unionByName, [
        *[broken("raw", name, df) for name, df in raw.items()],
        *[broken("staging", name, t.staged(name)) for name in raw]])


@query
def check_unique_composite(t: RetailTables) -> DataFrame:
    """Surplus lines on (receipt, product) over all sales, before any other check."""
    lines = t.sales.select(*sales_ops.RAW_COLUMNS)
    path = scratch_path(t.spark, "repeated_lines")
    return c.first_per_key(lines, sales_ops.LINE_KEY, sales_ops.LINE_ORDER, path).surplus


@query
def constraint_findings(t: RetailTables) -> DataFrame:
    return sales_ops.line_findings(t.split.rejected)


# Validation

@query
def duplicate_receipts(t: RetailTables) -> DataFrame:
    return t.duplicates


@query
def unmatched_products(t: RetailTables) -> DataFrame:
    return validation.unmatched_products(t.sales, t.raw("products"))


@query
def unmatched_staff(t: RetailTables) -> DataFrame:
    return validation.unmatched_staff(t.sales, t.raw("staff"))


@query
def validation_log(t: RetailTables) -> DataFrame:
    return t.log


@query
def audit_summary(t: RetailTables) -> DataFrame:
    return validation.findings_per_check(t.log)


@query
def audit_detail(t: RetailTables) -> DataFrame:
    return validation.findings_of(t.log, fixed.UNMATCHED_PRODUCT)


# Dimensions

@query
def dim_stores(t: RetailTables) -> DataFrame:
    return t.dimension("stores")


@query
def dim_staff(t: RetailTables) -> DataFrame:
    return t.dimension("staff")


@query
def dim_managers(t: RetailTables) -> DataFrame:
    return t.dimension("managers")


@query
def dim_products(t: RetailTables) -> DataFrame:
    return t.dimension("products")


@query
def dim_date(t: RetailTables) -> DataFrame:
    """A calendar of the years of the orders."""
    return dimensions.build_dim_date(
        dimensions.spine_of_years(t.table("orders"), "o_orderdate"))


@query
def dim_customers(t: RetailTables) -> DataFrame:
    return customers.build_dim_customers(
        t.keyless_fact, scratch_path(t.spark, "dim_customers"))


# Joins and the fact

def _line(*columns: str) -> tuple[str, ...]:
    return ("receipt_no", "product_sold", "quantity", *columns)


@query
def join_product(t: RetailTables) -> DataFrame:
    return fact.match_products(t.split.kept, t.dimension("products")).select(
        *_line("product_key", "product_name", "unit_price_ghs"))


@query
def join_store(t: RetailTables) -> DataFrame:
    return fact.match_stores(t.split.kept, t.dimension("stores")).select(
        *_line("store_id", "store_key"))


@query
def join_staff(t: RetailTables) -> DataFrame:
    return fact.match_staff(t.split.kept, t.dimension("staff")).select(
        *_line("store_id", "staff_name", "staff_key"))


@query
def join_date(t: RetailTables) -> DataFrame:
    return fact.match_dates(t.split.kept, t.dates).select(
        *_line("transaction_date", "date_key"))


@query
def exclude_flagged(t: RetailTables) -> DataFrame:
    return fact.without_flagged(t.split.kept, t.flagged).select(*_line("store_id"))


@query
def fact_transactions(t: RetailTables) -> DataFrame:
    return t.fact


@query
def fact_key_density(t: RetailTables) -> DataFrame:
    """Keyed fact rows: the keys run from 1 to the number of rows without gaps."""
    keyed = with_dense_key(
        t.keyless_fact, "transaction_key", scratch_path(t.spark, "fact_transactions"))
    return keyed.agg(
        _rows("fact_rows"),
        F.min("transaction_key").alias("first_key"),
        F.max("transaction_key").alias("last_key"),
        F.countDistinct("transaction_key").alias("different_keys"),
    )


# Integrity

def _orphans(t: RetailTables, dimension: DataFrame, key: str) -> DataFrame:
    return integrity.orphan_keys(t.fact, dimension, key)


def _reduced(dims: fact.Dimensions) -> dict[str, DataFrame]:
    """Dimensions that lost rows after the fact was built, so that orphans appear."""
    return {
        "store_key": dims.stores.filter(F.col("region") != "Offshore Region"),
        "staff_key": dims.staff.filter(F.col("employment_status") == "Active"),
        "product_key": dims.products.filter(F.col("category") != "PROMO"),
        "date_key": dims.dates.filter(F.col("year") < 1999),
    }


@query
def fk_store(t: RetailTables) -> DataFrame:
    return _orphans(t, _reduced(t.dims)["store_key"], "store_key")


@query
def fk_staff(t: RetailTables) -> DataFrame:
    return _orphans(t, _reduced(t.dims)["staff_key"], "staff_key")


@query
def fk_product(t: RetailTables) -> DataFrame:
    return _orphans(t, _reduced(t.dims)["product_key"], "product_key")


@query
def fk_date(t: RetailTables) -> DataFrame:
    return _orphans(t, _reduced(t.dims)["date_key"], "date_key")


@query
def fk_orphans(t: RetailTables) -> DataFrame:
    return integrity.orphan_counts(t.fact, {
        "store_key": t.dims.stores, "staff_key": t.dims.staff,
        "product_key": t.dims.products, "date_key": t.dims.dates,
    })


@query
def fk_orphans_injected(t: RetailTables) -> DataFrame:
    return integrity.orphan_counts(t.fact, _reduced(t.dims))


@query
def row_outcomes(t: RetailTables) -> DataFrame:
    return integrity.row_outcomes(t.split.kept, t.split.rejected, t.flagged, t.keyless_dims,
                                  scratch_path(t.spark, "outcome_lookups"))


# Reports

@query
def staging_counts(t: RetailTables) -> DataFrame:
    return reports.table_counts({
        f"staging.{name}": t.staged(name) for name in masters.STAGERS})


@query
def dim_counts(t: RetailTables) -> DataFrame:
    tables = {f"dim_{name}": t.dimension(name) for name in dimensions.DIMENSIONS}
    return reports.table_counts({**tables, "dim_date": t.dates})


@query
def fact_rows_by_store(t: RetailTables) -> DataFrame:
    return reports.fact_rows_by_store(t.keyless_fact)


@query
def top_customers(t: RetailTables) -> DataFrame:
    return customers.top_customers(customers.customer_visits(t.keyless_fact))


@query
def run_summary(t: RetailTables) -> DataFrame:
    return reports.table_counts({
        "raw.transactions": t.sales,
        **{f"raw.{name}": t.raw(name) for name in masters.STAGERS},
        **{f"staging.{name}": t.staged(name) for name in masters.STAGERS},
        "staging.transactions": t.split.kept,
        "audit.validation_log": t.log,
        "marts.dim_date": t.dates,
        "marts.fact_transactions": t.keyless_fact,
        "marts.dim_customers": customers.customer_visits(t.keyless_fact),
    })


@query
def top_store_for_product(t: RetailTables) -> DataFrame:
    return reports.top_store_for_product(t.keyless_fact, PRODUCT_TERM, WEEK_START)


@query
def top_store_per_week(t: RetailTables) -> DataFrame:
    return reports.top_store_per_week(t.keyless_fact, PRODUCT_TERM)


@query
def sales_by_store_month(t: RetailTables) -> DataFrame:
    return reports.sales_by_store_month(t.keyless_fact, t.dates)


@query
def sales_by_category(t: RetailTables) -> DataFrame:
    return reports.sales_by_category(t.keyless_fact)


@query
def sales_cube(t: RetailTables) -> DataFrame:
    return reports.sales_cube(t.keyless_fact)


@query
def sales_on_days(t: RetailTables) -> DataFrame:
    """Weekend sales of the spring quarters, from a fact stored by month."""
    path = scratch_path(t.spark, "fact_by_month")
    t.fact.withColumn("sale_month", F.date_format("transaction_date", "yyyy-MM")).hint(
        "rebalance", "sale_month").write.partitionBy("sale_month").parquet(path)
    stored = t.spark.read.schema(T.StructType(
        [*t.fact.schema, T.StructField("sale_month", T.StringType())])).parquet(path)
    return reports.sales_on_days(
        stored, t.dates.filter((F.col("quarter") == 2) & F.col("is_weekend")))


# Sales laid out by receipt

def _by_receipt(t: RetailTables, sales: DataFrame) -> receipts.ByReceipt:
    path = scratch_path(t.spark, "by_receipt")
    return receipts.write_by_receipt(
        sales, f"by_receipt_{path.rsplit('-', 1)[1]}", path, buckets=16)


@query
def exclude_flagged_by_receipt(t: RetailTables) -> DataFrame:
    return receipts.exclude_flagged(_by_receipt(t, t.split.kept), t.flagged).select(
        *_line("store_id"))


@query
def repeated_keys_by_receipt(t: RetailTables) -> DataFrame:
    return receipts.repeated_keys(_by_receipt(t, t.sales), "product_sold")


# Loads that build on each other

def _two_lists(t: RetailTables, name: str) -> tuple[DataFrame, DataFrame]:
    """A master list at two times: some entries come later, others are dropped by then."""
    staged = t.staged(name)
    number = F.regexp_extract(dimensions.DIMENSIONS[name][1], "[0-9]+", 0).cast("int")
    return staged.filter(number % 10 != 3), staged.filter(number % 7 != 2)


@query
def lasting_keys(t: RetailTables) -> DataFrame:
    """Keys after two loads: those of the first stay, dropped masters keep theirs."""
    parts = []
    for name, (key, business_id, _) in dimensions.DIMENSIONS.items():
        first, second = _two_lists(t, name)
        path = scratch_path(t.spark, f"lasting_{name}")
        known = dimensions.extend_dimension(name, None, first, f"{path}/1")
        both = dimensions.extend_dimension(name, known, second, f"{path}/2")
        now = dimensions.current_rows(name, both, second).select(
            business_id, F.lit(True).alias("is_current"))
        parts.append(both.join(now, business_id, "left").select(
            F.lit(name).alias("dimension"), F.col(business_id).alias("business_id"),
            F.col(key).alias("surrogate_key"),
            F.coalesce("is_current", F.lit(False)).alias("is_current")))
    return reduce(DataFrame.unionByName, parts)


def _in_two_loads(t: RetailTables) -> tuple[MonthlySales, list[tuple[Load, list[str]]]]:
    """Sales by month after two loads, with the state and the rebuilt months of each."""
    monthly = MonthlySales(t.spark, scratch_path(t.spark, "monthly"))
    masters = {name: t.staged(name) for name in MATCHED}
    later = F.substring("timestamp", 1, 7).isin(*star_tables.SECOND_LOAD)
    return monthly, [monthly.add(lines, masters, t.dates)
                     for lines in (t.sales.filter(~later), t.sales.filter(later))]


@query
def incremental_fact(t: RetailTables) -> DataFrame:
    """The fact after a second load of two months, and which rows that load built again."""
    monthly, (_, (state, touched)) = _in_two_loads(t)
    return monthly.fact(state).withColumn(
        "rebuilt", F.col("sale_month").isin(touched)).drop("transaction_key", "sale_month")


@query
def incremental_customers(t: RetailTables) -> DataFrame:
    """Visits after a second load, from the bitmaps of its months and of those that stay."""
    monthly, loads = _in_two_loads(t)
    kept = MonthlyVisits(monthly)
    for state, _ in loads:
        kept.add(state)
    return kept.customers(state)


@query
def full_refresh(t: RetailTables) -> DataFrame:
    """Rows of the stored layers of a whole run, counted in their files."""
    first_day, last_day = star_tables.sales_years(t.spark, t.folder)
    raw = {name: t.raw(name) for name in ("transactions", *MASTERS)}
    root = scratch_path(t.spark, "warehouse")
    result = run_pipeline(t.spark, raw, root, WarehouseConfig(
        spine_start=first_day, spine_end=last_day, constraint_policy="report"))
    counted = [table for *_, table, _, _ in result.metrics.rows]
    layers = Layers(t.spark, root)
    return reports.table_counts({name: layers.read(name) for name in counted})


# Streams

@query
def stream_ingest(t: RetailTables) -> DataFrame:
    """The order lines taken in as a stream equal the staged sales."""
    out = scratch_path(t.spark, "stream_ingest")
    ingest.ingest_sales(
        star_tables.raw_sales_stream(t.spark, t.folder), out, f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/sales").drop(ingest.BATCH)


@query
def stream_fact(t: RetailTables) -> DataFrame:
    """Staged sales enriched as a stream of files equal the fact."""
    out = scratch_path(t.spark, "stream_fact")
    t.split.kept.write.parquet(f"{out}/sales")
    arriving = t.spark.readStream.schema(t.split.kept.schema).parquet(f"{out}/sales")
    ingest.enrich_sales(arriving, t.dims, t.flagged, f"{out}/fact", f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/fact")


def _in_deliveries(t: RetailTables, name: str, take_in: Callable[[DataFrame, str], None]) -> str:
    """The folder of a stream that took in the deliveries one after the other."""
    sent = scratch_path(t.spark, f"{name}_landing")
    out = scratch_path(t.spark, name)
    lines = star_tables.deliveries(t.spark, t.folder)
    lines.write.partitionBy("delivery").parquet(f"{sent}/all")
    whole = t.spark.read.parquet(f"{sent}/all")
    for number in range(1, 5):
        part = whole.filter(F.col("delivery") == number).drop("delivery")
        part.write.mode("append").parquet(f"{sent}/arrived")
        take_in(t.spark.readStream.schema(part.schema).parquet(f"{sent}/arrived"), out)
    return out


@query
def stream_dedup(t: RetailTables) -> DataFrame:
    """Every line of four deliveries with its outcome: kept, known, broken or too late."""
    out = _in_deliveries(
        t, "stream_dedup", lambda raw, out: state.ingest_deduplicated(raw, out, "35 days"))
    return state.outcomes(t.spark, out)


@query
def stream_flagged(t: RetailTables) -> DataFrame:
    """Receipts with too many lines, and the delivery that took them over the limit."""
    out = _in_deliveries(t, "stream_flagged", state.flag_receipts)
    return state.found_receipts(t.spark, out).select(
        *validation.FINDING, (F.col("batch") + 1).cast("int").alias("delivery"))
