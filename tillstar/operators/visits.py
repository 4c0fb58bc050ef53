"""Visits of customers as bitmaps of receipt numbers, which merge exactly.

A receipt has one lasting number. The receipts of a customer are bits of bitmaps of
32,768 numbers each, so the same receipt seen in two parts of the fact is one bit,
and the visits of all parts are the bits of their bitmaps joined by OR.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMBER = "receipt_number"


def customer_receipts(fact: DataFrame, part: str) -> DataFrame:
    """Each receipt of each customer once per ``part`` of the fact, with its first day.

    Lines without a phone leave first. Lines are combined before the shuffle, and the
    receipt is part of the key, so a customer with very many receipts is spread over tasks.
    """
    known = fact.filter(F.col("customer_phone").isNotNull() & (F.col("customer_phone") != ""))
    return known.groupBy(part, "customer_phone", "receipt_no").agg(
        F.min(F.to_date("transaction_date")).alias("first_seen_date"))


def visit_bitmaps(receipts: DataFrame, numbers: DataFrame, part: str) -> DataFrame:
    """Bitmaps per part, customer and bucket of receipt numbers.

    ``numbers`` has one row per receipt. Lines without a receipt keep the customer and the
    day with an empty bitmap, under no bucket.
    """
    number = F.col(NUMBER)
    return receipts.join(numbers, "receipt_no", "left").groupBy(
        part, "customer_phone", F.bitmap_bucket_number(number).alias("bucket")
    ).agg(
        F.min("first_seen_date").alias("first_seen_date"),
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("receipts"),
    )


def merged_visits(bitmaps: DataFrame) -> DataFrame:
    """First day and number of different receipts per customer, over all parts.

    A bitmap is bounded, so the parts of one bucket combine to one row per task; a
    customer's buckets are summed as numbers.
    """
    by_bucket = bitmaps.groupBy("customer_phone", "bucket").agg(
        F.min("first_seen_date").alias("first_seen_date"),
        F.bitmap_count(F.bitmap_or_agg("receipts")).alias("visits"))
    return by_bucket.groupBy("customer_phone").agg(
        F.min("first_seen_date").alias("first_seen_date"), F.sum("visits").alias("total_visits"))
