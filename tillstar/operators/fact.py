"""The sales fact: typed sales lines matched to the dimensions.

Every join has the sales on the left and a dimension on the right. Dimensions
are broadcast only when the planner's size estimate allows it; otherwise both
sides are shuffled on the key and AQE splits the partitions of hot keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import blank_to_null, money, norm_key, trimmed


@dataclass(frozen=True)
class Dimensions:
    stores: DataFrame
    staff: DataFrame
    products: DataFrame
    dates: DataFrame


def match_products(sales: DataFrame, products: DataFrame, how: str = "inner") -> DataFrame:
    """Product by name; a name carried by several products gives a row for each."""
    right = products.select(
        norm_key("product_name").alias("product_match"),
        "product_key", "product_name", "category", "unit_price_ghs",
    )
    return sales.join(right, norm_key("product_sold") == F.col("product_match"), how).drop(
        "product_match"
    )


def match_stores(sales: DataFrame, stores: DataFrame, how: str = "inner") -> DataFrame:
    right = stores.select(trimmed("store_id").alias("store_match"), "store_key")
    return sales.join(right, trimmed("store_id") == F.col("store_match"), how).drop("store_match")


def match_staff(sales: DataFrame, staff: DataFrame, how: str = "inner") -> DataFrame:
    """Staff by name within the store; a known name in another store does not match."""
    right = staff.select(
        norm_key("full_name").alias("staff_match"),
        trimmed("store_id").alias("staff_store"),
        "staff_key",
    )
    same = (norm_key("staff_name") == F.col("staff_match")) & (
        trimmed("store_id") == F.col("staff_store")
    )
    return sales.join(right, same, how).drop("staff_match", "staff_store")


def match_dates(sales: DataFrame, dates: DataFrame, how: str = "inner") -> DataFrame:
    right = dates.select("full_date", "date_key")
    return sales.join(right, F.to_date("transaction_date") == F.col("full_date"), how).drop(
        "full_date"
    )


def without_flagged(sales: DataFrame, flagged: DataFrame) -> DataFrame:
    """Drop the lines of flagged receipts; a NULL receipt never matches and stays."""
    return sales.join(flagged, "receipt_no", "left_anti")


def build_fact(sales: DataFrame, dims: Dimensions, flagged: DataFrame) -> DataFrame:
    """Fact rows without their key."""
    matched = without_flagged(sales, flagged)
    matched = match_dates(matched, dims.dates)
    matched = match_stores(matched, dims.stores)
    matched = match_staff(matched, dims.staff)
    return fact_columns(match_products(matched, dims.products))


def trace_lines(sales: DataFrame, dims: Dimensions, flagged: DataFrame) -> DataFrame:
    """Every sales line matched as far as it goes, with its ``outcome``.

    The rows ``in_fact`` are those of ``build_fact``. A line that meets several rows of a
    dimension fans out; ``is_line`` is true for one of its rows, so lines can be counted
    in the same pass. Only the dimensions are numbered, per matching name.
    """
    def numbered(df: DataFrame, *match: Column) -> DataFrame:
        return df.withColumn("no", F.row_number().over(Window.partitionBy(*match).orderBy(F.lit(0))))

    receipts = flagged.select(F.col("receipt_no").alias("f_receipt")).distinct()
    dates = numbered(dims.dates, F.col("full_date")).select(
        F.col("full_date").alias("d_date"), "date_key", F.col("no").alias("d_no"))
    stores = numbered(dims.stores, trimmed("store_id")).select(
        trimmed("store_id").alias("s_store"), "store_key", F.col("no").alias("s_no"))
    staff = numbered(dims.staff, norm_key("full_name"), trimmed("store_id")).select(
        norm_key("full_name").alias("e_name"), trimmed("store_id").alias("e_store"), "staff_key",
        F.col("no").alias("e_no"))
    products = numbered(dims.products, norm_key("product_name")).select(
        norm_key("product_name").alias("p_name"), "product_key", "product_name", "category",
        "unit_price_ghs", F.col("no").alias("p_no"))
    at_store = trimmed("store_id")
    traced = (
        sales.join(receipts, F.col("receipt_no") == F.col("f_receipt"), "left")
        .join(dates, F.to_date("transaction_date") == F.col("d_date"), "left")
        .join(stores, at_store == F.col("s_store"), "left")
        .join(staff, (norm_key("staff_name") == F.col("e_name"))
              & (at_store == F.col("e_store")), "left")
        .join(products, norm_key("product_sold") == F.col("p_name"), "left")
    )
    outcome = (
        F.when(F.col("f_receipt").isNotNull(), "flagged_receipt")
        .when(F.col("p_no").isNull(), "no_product")
        .when(F.col("s_no").isNull(), "no_store")
        .when(F.col("e_no").isNull(), "no_staff")
        .when(F.col("d_no").isNull(), "no_date")
        .otherwise("in_fact")
    )
    first = [F.coalesce(F.col(no), F.lit(1)) == 1 for no in ("d_no", "s_no", "e_no", "p_no")]
    return traced.select(
        "*", outcome.alias("outcome"), (first[0] & first[1] & first[2] & first[3]).alias("is_line"))


def fact_columns(matched: DataFrame) -> DataFrame:
    return matched.select(
        "receipt_no",
        "transaction_date",
        "store_id",
        "staff_name",
        blank_to_null("customer_phone").alias("customer_phone"),
        "product_name",
        "category",
        "quantity",
        "unit_price_ghs",
        money("quantity", "unit_price_ghs").alias("total_amount_ghs"),
        "payment_method",
        "source_sheet",
        "store_key",
        "staff_key",
        "product_key",
        "date_key",
    )
