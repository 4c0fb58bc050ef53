"""Master lists: raw text to typed staging tables, and their constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import fixed_values as fixed
from tillstar.functions import (
    blank_to_null,
    is_number_text,
    parse_price,
    parse_serial_date,
    trimmed,
)
from tillstar.operators.constraints import RowCheck, in_domain, not_null, positive


def filled(column: str) -> Column:
    """Keeps rows whose cell is neither NULL nor empty; a cell of spaces passes."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def in_list(column: str, values: Sequence[str]) -> Column:
    return trimmed(column).isin(*values)


def _clean(*columns: str) -> list[Column]:
    return [trimmed(c).alias(c) for c in columns]


def _optional(*columns: str) -> list[Column]:
    return [blank_to_null(c).alias(c) for c in columns]


def stage_stores(raw: DataFrame) -> DataFrame:
    return raw.filter(filled("store_id")).select(*_clean("store_id", "city", "region"))


def stage_staff(raw: DataFrame) -> DataFrame:
    known = (
        filled("staff_id")
        & in_list("role", fixed.STAFF_ROLES)
        & in_list("employment_status", fixed.EMPLOYMENT_STATUSES)
    )
    return raw.filter(known).select(
        *_clean("staff_id", "full_name", "role", "store_id"),
        *_optional("phone_number"),
        parse_serial_date("date_hired").alias("date_hired"),
        *_clean("employment_status"),
    )


def stage_managers(raw: DataFrame) -> DataFrame:
    known = filled("manager_id") & in_list("role", fixed.MANAGER_ROLES)
    return raw.filter(known).select(
        *_clean("manager_id", "full_name", "role", "store_id"),
        *_optional("phone_number", "email"),
        parse_serial_date("date_appointed").alias("date_appointed"),
        *_optional("reports_to"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    known = filled("product_id") & filled("unit_price_ghs") & is_number_text("unit_price_ghs")
    return raw.filter(known).select(
        *_clean("product_id", "product_name", "category"),
        parse_price("unit_price_ghs").alias("unit_price_ghs"),
        F.lit(None).cast("date").alias("last_updated"),
        *_optional("updated_by"),
    )


STAGERS = {
    "stores": stage_stores,
    "staff": stage_staff,
    "managers": stage_managers,
    "products": stage_products,
}

PRIMARY_KEYS = {
    "stores": "store_id",
    "staff": "staff_id",
    "managers": "manager_id",
    "products": "product_id",
}


def master_checks(name: str) -> list[RowCheck]:
    """Constraints of a typed master table."""
    required = {
        "stores": ["store_id", "city", "region"],
        "staff": ["staff_id", "full_name", "role", "store_id", "employment_status"],
        "managers": ["manager_id", "full_name", "role", "store_id"],
        "products": ["product_id", "product_name", "category", "unit_price_ghs"],
    }
    checks = [not_null(c) for c in required[name]]
    if name == "stores":
        checks.append(in_domain("region", fixed.REGIONS))
    elif name == "staff":
        checks.append(in_domain("role", fixed.STAFF_ROLES))
        checks.append(in_domain("employment_status", fixed.EMPLOYMENT_STATUSES))
    elif name == "managers":
        checks.append(in_domain("role", fixed.MANAGER_ROLES))
    else:
        checks.append(positive("unit_price_ghs"))
    return checks
