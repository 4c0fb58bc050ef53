"""Table schemas of the four layers.

Surrogate keys and counts are BIGINT: a 32-bit key would run out at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
BIGINT = T.LongType()
INT = T.IntegerType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()
BOOL = T.BooleanType()
MONEY = T.DecimalType(10, 2)


def _required(dtype: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, dtype, False) for name in names]


def _optional(dtype: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name in names]


def _table(*parts: list[T.StructField]) -> T.StructType:
    return T.StructType([field for part in parts for field in part])


SCHEMAS: dict[str, T.StructType] = {
    "raw.transactions": _table(
        _optional(TEXT, "timestamp", "store_id", "staff_name", "receipt_no", "customer_phone",
                  "product_sold", "quantity", "payment_method", "source_sheet"),
        _optional(STAMP, "extracted_at"),
    ),
    "raw.products": _table(
        _optional(TEXT, "product_id", "product_name", "category", "unit_price_ghs",
                  "last_updated", "updated_by"),
        _optional(STAMP, "extracted_at"),
    ),
    "raw.staff": _table(
        _optional(TEXT, "staff_id", "full_name", "role", "store_id", "store_city",
                  "phone_number", "date_hired", "employment_status"),
        _optional(STAMP, "extracted_at"),
    ),
    "raw.managers": _table(
        _optional(TEXT, "manager_id", "full_name", "role", "store_id", "phone_number",
                  "email", "date_appointed", "reports_to"),
        _optional(STAMP, "extracted_at"),
    ),
    "raw.stores": _table(
        _optional(TEXT, "store_id", "city", "region"),
        _optional(STAMP, "extracted_at"),
    ),
    "staging.transactions": _table(
        _required(BIGINT, "transaction_id"),
        _required(STAMP, "transaction_date"),
        _required(TEXT, "store_id", "staff_name", "receipt_no"),
        _optional(TEXT, "customer_phone"),
        _required(TEXT, "product_sold"),
        _required(INT, "quantity"),
        _required(TEXT, "payment_method", "source_sheet"),
        _optional(STAMP, "extracted_at"),
    ),
    "staging.transactions_rejected": _table(
        _optional(TEXT, "timestamp", "store_id", "staff_name", "receipt_no", "customer_phone",
                  "product_sold", "quantity", "payment_method", "source_sheet"),
        _required(TEXT, "failed_checks"),
        _required(BIGINT, "copies"),
        _optional(STAMP, "extracted_at"),
    ),
    "staging.products": _table(
        _required(TEXT, "product_id", "product_name", "category"),
        _required(MONEY, "unit_price_ghs"),
        _optional(DATE, "last_updated"),
        _optional(TEXT, "updated_by"),
        _optional(STAMP, "extracted_at"),
    ),
    "staging.staff": _table(
        _required(TEXT, "staff_id", "full_name", "role", "store_id"),
        _optional(TEXT, "phone_number"),
        _optional(DATE, "date_hired"),
        _required(TEXT, "employment_status"),
        _optional(STAMP, "extracted_at"),
    ),
    "staging.managers": _table(
        _required(TEXT, "manager_id", "full_name", "role", "store_id"),
        _optional(TEXT, "phone_number", "email"),
        _optional(DATE, "date_appointed"),
        _optional(TEXT, "reports_to"),
        _optional(STAMP, "extracted_at"),
    ),
    "staging.stores": _table(
        _required(TEXT, "store_id", "city", "region"),
        _optional(STAMP, "extracted_at"),
    ),
    "audit.validation_log": _table(
        _required(BIGINT, "log_id"),
        _required(TEXT, "table_name", "check_name"),
        _optional(TEXT, "store_id", "source_sheet", "raw_value"),
        _optional(STAMP, "flagged_at"),
    ),
    "audit.constraint_log": _table(
        _required(TEXT, "table_name", "check_name"),
        _optional(TEXT, "store_id", "source_sheet", "raw_value"),
        _required(BIGINT, "copies"),
        _optional(STAMP, "flagged_at"),
    ),
    "marts.dim_stores": _table(
        _required(BIGINT, "store_key"),
        _required(TEXT, "store_id", "city", "region"),
    ),
    "marts.dim_staff": _table(
        _required(BIGINT, "staff_key"),
        _required(TEXT, "staff_id", "full_name", "role", "store_id"),
        _optional(TEXT, "phone_number"),
        _optional(DATE, "date_hired"),
        _required(TEXT, "employment_status"),
    ),
    "marts.dim_managers": _table(
        _required(BIGINT, "manager_key"),
        _required(TEXT, "manager_id", "full_name", "role", "store_id"),
        _optional(TEXT, "phone_number", "email"),
        _optional(DATE, "date_appointed"),
        _optional(TEXT, "reports_to"),
    ),
    "marts.dim_products": _table(
        _required(BIGINT, "product_key"),
        _required(TEXT, "product_id", "product_name", "category"),
        _required(MONEY, "unit_price_ghs"),
    ),
    "marts.dim_date": _table(
        _required(BIGINT, "date_key"),
        _required(DATE, "full_date"),
        _required(TEXT, "day_of_week"),
        _required(INT, "day_num", "month_num"),
        _required(TEXT, "month_name"),
        _required(INT, "quarter", "year"),
        _required(BOOL, "is_weekend"),
    ),
    "marts.fact_transactions": _table(
        _required(BIGINT, "transaction_key"),
        _required(TEXT, "receipt_no"),
        _required(STAMP, "transaction_date"),
        _required(TEXT, "store_id", "staff_name"),
        _optional(TEXT, "customer_phone"),
        _required(TEXT, "product_name", "category"),
        _required(INT, "quantity"),
        _required(MONEY, "unit_price_ghs", "total_amount_ghs"),
        _required(TEXT, "payment_method", "source_sheet"),
        _optional(BIGINT, "store_key", "staff_key", "product_key", "date_key"),
    ),
    "marts.dim_customers": _table(
        _required(BIGINT, "customer_key"),
        _required(TEXT, "customer_phone"),
        _optional(DATE, "first_seen_date"),
        _optional(BIGINT, "total_visits"),
    ),
}


def load_time() -> Column:
    """The time of the load, one value per query."""
    return F.current_timestamp().cast("timestamp_ntz")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of ``table``; load-time columns are stamped when absent."""
    columns = []
    for field in SCHEMAS[table]:
        if field.name not in df.columns and field.name in ("extracted_at", "flagged_at"):
            columns.append(load_time().alias(field.name))
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def business_columns(table: str) -> list[str]:
    """Columns of ``table`` without load times and row numbers of the load itself."""
    return [f.name for f in SCHEMAS[table]
            if f.name not in ("extracted_at", "flagged_at", "transaction_id", "log_id")]
