"""Sales lines: raw text to typed staging rows, with quarantine of bad rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar import fixed_values as fixed
from tillstar.functions import blank_to_null, parse_count, parse_timestamp
from tillstar.operators import constraints as c
from tillstar.sources.landed import SALES_COLUMNS

LINE_KEY = ("receipt_no", "product_sold")
# Which of several equal (receipt, product) lines stays: the first in this order.
LINE_ORDER = ("timestamp", "store_id", "staff_name", "quantity", "payment_method",
              "customer_phone", "source_sheet")
RAW_COLUMNS = SALES_COLUMNS
UNIQUE_LINE = "receipt_product_unique"


def typed_sales(raw: DataFrame) -> DataFrame:
    """Typed columns; text is kept as it came, because receipts and names match verbatim."""
    return raw.select(
        parse_timestamp("timestamp").alias("transaction_date"),
        "store_id",
        "staff_name",
        "receipt_no",
        blank_to_null("customer_phone").alias("customer_phone"),
        "product_sold",
        parse_count("quantity").alias("quantity"),
        "payment_method",
        "source_sheet",
    )


def line_checks() -> list[c.RowCheck]:
    """Row constraints of a sales line, over raw text plus the two parsed columns."""
    return [
        c.not_null("transaction_date", shown="timestamp"),
        c.not_null("store_id"),
        c.not_null("staff_name"),
        c.not_null("receipt_no"),
        c.not_null("product_sold"),
        c.RowCheck("quantity_not_null", F.col("units").isNull(), F.col("quantity")),
        c.not_null("payment_method"),
        c.not_null("source_sheet"),
        c.RowCheck("quantity_range", ~F.col("units").between(*fixed.QUANTITY_RANGE),
                   F.col("quantity")),
        c.in_domain("payment_method", fixed.PAYMENT_METHODS),
    ]


@dataclass(frozen=True)
class SalesSplit:
    """``kept`` is typed, ``lines`` the same as raw text; ``rejected`` is raw text with
    ``failed_checks`` and ``copies``."""

    kept: DataFrame
    rejected: DataFrame
    lines: DataFrame


def split_sales(
    raw: DataFrame, path: str, order: Sequence[str] = LINE_ORDER
) -> SalesSplit:
    """Separate valid sales lines from those breaking a constraint.

    Row checks run first; the (receipt, product) key is then unique among the
    rows that passed them, as the database would have it. ``path`` is scratch
    space for the repeated keys, which are looked up at once. ``order`` decides which
    line of a key stays; columns that it names beyond the raw ones are kept beside them.
    """
    columns = [*RAW_COLUMNS, *[c for c in order if c not in RAW_COLUMNS]]
    parsed = raw.select(
        *columns,
        parse_timestamp("timestamp").alias("transaction_date"),
        parse_count("quantity").alias("units"),
    )
    checks = line_checks()
    sound = c.passing(parsed, checks).select(*columns)
    lines = c.first_per_key(sound, LINE_KEY, order, path)
    broken = c.failing(parsed, checks).select(
        *columns, "failed_checks", F.lit(1).cast("bigint").alias("copies")
    )
    surplus = lines.surplus.withColumn("failed_checks", F.lit(UNIQUE_LINE))
    return SalesSplit(typed_sales(lines.kept), broken.unionByName(surplus), lines.kept)


def line_findings(rejected: DataFrame) -> DataFrame:
    """Audit rows of rejected lines: one per failed check, with the offending value.

    Only the rejected lines are read, not the raw sales again.
    """
    shown = F.when(F.col("check_name") == UNIQUE_LINE, F.concat_ws("|", *LINE_KEY))
    for check in line_checks():
        shown = shown.when(F.col("check_name") == check.name, check.shown)
    return (
        rejected.withColumn("check_name", F.explode(F.split("failed_checks", ",")))
        .select(
            F.lit("staging.transactions").alias("table_name"), "check_name",
            "store_id", "source_sheet", shown.alias("raw_value"), "copies",
        )
    )
