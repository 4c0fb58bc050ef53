"""Audit checks on the raw layer.

A check compares raw sales with raw masters; the fact later joins the filtered
staging masters, so passing a check does not promise a place in the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar import fixed_values as fixed
from tillstar.functions import norm_key

FINDING = ("table_name", "check_name", "store_id", "source_sheet", "raw_value")


def _findings(df: DataFrame, check_name: str) -> DataFrame:
    return df.select(
        F.lit("raw.transactions").alias("table_name"),
        F.lit(check_name).alias("check_name"),
        "store_id", "source_sheet", "raw_value",
    )


def duplicate_receipts(sales: DataFrame, limit: int = fixed.RECEIPT_REPEAT_LIMIT) -> DataFrame:
    """Receipts on more than ``limit`` lines of one store and sheet."""
    groups = sales.groupBy("store_id", "source_sheet", "receipt_no").agg(
        F.count(F.lit(1)).alias("lines"))
    return receipt_findings(groups.filter(F.col("lines") > limit))


def receipt_findings(receipts: DataFrame) -> DataFrame:
    """Findings of receipts that are counted already."""
    return _findings(
        receipts.withColumnRenamed("receipt_no", "raw_value"), fixed.DUPLICATE_RECEIPT)


def _unmatched(sales: DataFrame, column: str, known: DataFrame, name: str, check: str) -> DataFrame:
    # The few distinct names per sheet are joined, not the sales lines.
    names = (
        sales.filter(F.col(column).isNotNull() & (F.col(column) != ""))
        .select("store_id", "source_sheet", F.col(column).alias("raw_value"))
        .distinct()
    )
    keys = known.select(norm_key(name).alias("known_key")).distinct()
    return _findings(
        names.join(keys, norm_key("raw_value") == F.col("known_key"), "left_anti"), check
    )


def unmatched_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _unmatched(sales, "product_sold", products, "product_name", fixed.UNMATCHED_PRODUCT)


def unmatched_staff(sales: DataFrame, staff: DataFrame) -> DataFrame:
    return _unmatched(sales, "staff_name", staff, "full_name", fixed.UNMATCHED_STAFF)


def validation_log(
    sales: DataFrame,
    products: DataFrame,
    staff: DataFrame,
    limit: int = fixed.RECEIPT_REPEAT_LIMIT,
) -> DataFrame:
    """All three checks in one pass over the sales.

    Each line yields its three (check, value) pairs, which are counted per store
    and sheet with map-side combining: one scan and one shuffle instead of three.
    Receipts within the limit leave before the anti-join, so only names and
    findings are joined with the masters.
    """
    pairs = sales.select(
        "store_id", "source_sheet",
        F.explode(F.array(
            F.struct(F.lit(fixed.DUPLICATE_RECEIPT).alias("check_name"),
                     F.col("receipt_no").alias("raw_value")),
            F.struct(F.lit(fixed.UNMATCHED_PRODUCT).alias("check_name"),
                     F.col("product_sold").alias("raw_value")),
            F.struct(F.lit(fixed.UNMATCHED_STAFF).alias("check_name"),
                     F.col("staff_name").alias("raw_value")),
        )).alias("pair"),
    ).select("store_id", "source_sheet", "pair.check_name", "pair.raw_value")

    is_receipt = F.col("check_name") == fixed.DUPLICATE_RECEIPT
    suspects = (
        pairs.filter(is_receipt | (F.col("raw_value") != ""))
        .groupBy("store_id", "source_sheet", "check_name", "raw_value")
        .agg(F.count(F.lit(1)).alias("lines"))
        .filter(~is_receipt | (F.col("lines") > limit))
    )
    known = (
        products.select(F.lit(fixed.UNMATCHED_PRODUCT).alias("known_check"),
                        norm_key("product_name").alias("known_key"))
        .unionByName(staff.select(F.lit(fixed.UNMATCHED_STAFF).alias("known_check"),
                                  norm_key("full_name").alias("known_key")))
        .distinct()
    )
    same_name = (F.col("check_name") == F.col("known_check")) & (
        norm_key("raw_value") == F.col("known_key")
    )
    return suspects.join(known, same_name, "left_anti").select(
        F.lit("raw.transactions").alias("table_name"), *FINDING[1:]
    )


def findings_per_check(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("check_name").agg(F.count(F.lit(1)).alias("findings"))
        .orderBy(F.desc("findings"), "check_name")
    )


def findings_of(log: DataFrame, check_name: str) -> DataFrame:
    """Detail of one check."""
    return log.filter(F.col("check_name") == check_name).select(
        "store_id", "source_sheet", "raw_value"
    )


def flagged_receipts(log: DataFrame) -> DataFrame:
    """Receipt numbers flagged in any store; they leave the fact everywhere."""
    return (
        log.filter(F.col("check_name") == fixed.DUPLICATE_RECEIPT)
        .select(F.col("raw_value").alias("receipt_no"))
        .distinct()
    )
