"""Row counts and cross-store sales reports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table, by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def fact_rows_by_store(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("store_id").agg(F.count(F.lit(1)).alias("transaction_rows"))
        .orderBy("store_id")
    )


def top_store_for_product(fact: DataFrame, term: str, week_start: date) -> DataFrame:
    """The store that sold most units of products named like ``term`` in one week.

    The stores' totals are combined before the sort; equal totals go to the
    lowest store id. The week also prunes the month partitions of a stored fact.
    """
    week_end = week_start + timedelta(days=7)
    stamp = F.col("transaction_date")
    sold = fact.filter(
        (stamp >= F.lit(week_start)) & (stamp < F.lit(week_end))
        & F.contains(F.lower("product_name"), F.lit(term.lower()))
    )
    if "sale_month" in fact.columns:
        sold = sold.filter(F.col("sale_month").between(_month(week_start), _month(week_end)))
    return (
        sold.groupBy("store_id").agg(F.sum("quantity").alias("units_sold"))
        .orderBy(F.desc("units_sold"), "store_id")
        .limit(1)
    )


def top_store_per_week(fact: DataFrame, term: str) -> DataFrame:
    """The best-selling store of every week (from Monday) for products named like ``term``."""
    weekly = (
        fact.filter(F.contains(F.lower("product_name"), F.lit(term.lower())))
        .groupBy(F.to_date(F.date_trunc("week", "transaction_date")).alias("week_start"),
                 "store_id")
        .agg(F.sum("quantity").alias("units_sold"))
    )
    best_first = Window.partitionBy("week_start").orderBy(F.desc("units_sold"), "store_id")
    return (
        weekly.withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") == 1)
        .select("week_start", "store_id", "units_sold")
    )


def sales_by_store_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Lines, units and revenue per store and calendar month.

    The fact is summed per store and day before it meets the calendar.
    """
    daily = fact.groupBy("store_id", "date_key").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("total_amount_ghs").alias("revenue"),
    )
    return (
        daily.join(dates.select("date_key", "year", "month_num"), "date_key")
        .groupBy("store_id", "year", "month_num")
        .agg(F.sum("lines").alias("sales_lines"), F.sum("units").alias("units_sold"),
             F.sum("revenue").cast("decimal(28,2)").alias("revenue_ghs"))
    )


def _measures() -> list:
    return [F.count(F.lit(1)).alias("sales_lines"), F.sum("quantity").alias("units_sold"),
            F.sum("total_amount_ghs").cast("decimal(28,2)").alias("revenue_ghs")]


def sales_cube(fact: DataFrame) -> DataFrame:
    """Sales by store, month and category, by each two and each one of them, and in all.

    One scan: lines are summed per store, month and category first, and only these sums
    are expanded into the grouping sets. ``level`` tells the sets apart: a bit is set
    for each column (store 4, month 2, category 1) that is summed over.
    """
    finest = fact.groupBy(
        "store_id", F.date_format("transaction_date", "yyyy-MM").alias("month"), "category"
    ).agg(*_measures())
    store, month, category = F.col("store_id"), F.col("month"), F.col("category")
    sets = [[store, month, category], [store, month], [store, category], [month, category],
            [store], [month], [category], []]
    return finest.groupingSets(sets, store, month, category).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("sales_lines").alias("sales_lines"), F.sum("units_sold").alias("units_sold"),
        F.sum("revenue_ghs").cast("decimal(28,2)").alias("revenue_ghs"))


def sales_on_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Sales per store on some days of the calendar, from a fact stored by month.

    The days' months are a join key beside the date key, so that a filter on the calendar
    reaches the scan of the fact as a dynamic pruning of its month folders.
    """
    wanted = days.select("date_key", F.date_format("full_date", "yyyy-MM").alias("sale_month"))
    return fact.join(wanted, ["sale_month", "date_key"]).groupBy("store_id").agg(*_measures())


def sales_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category").agg(
        F.count(F.lit(1)).alias("sales_lines"),
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount_ghs").cast("decimal(28,2)").alias("revenue_ghs"),
    )


def _month(day: date) -> str:
    return f"{day:%Y-%m}"
