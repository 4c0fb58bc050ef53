"""Customers derived from the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import with_dense_key


def customer_visits(fact: DataFrame) -> DataFrame:
    """First day and number of different receipts per phone number.

    Lines without a phone leave first, so walk-ins never form a hot group. The
    distinct count is planned in two steps, (phone, receipt) and then phone, so
    a phone with very many receipts is spread over tasks too.
    """
    known = fact.filter(F.col("customer_phone").isNotNull() & (F.col("customer_phone") != ""))
    return known.groupBy("customer_phone").agg(
        F.min(F.to_date("transaction_date")).alias("first_seen_date"),
        F.countDistinct("receipt_no").alias("total_visits"),
    )


def build_dim_customers(fact: DataFrame, path: str) -> DataFrame:
    """Customers keyed in the order of their phone number."""
    return with_dense_key(customer_visits(fact), "customer_key", path, ["customer_phone"])


def top_customers(customers: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` customers with most visits; equal counts go by phone number."""
    return (
        customers.select("customer_phone", "first_seen_date", "total_visits")
        .orderBy(F.desc("total_visits"), "customer_phone")
        .limit(n)
    )
