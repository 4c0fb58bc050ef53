"""Dimensions too big to broadcast, and one product that holds a third of all lines."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators.fact import match_products, without_flagged

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def shuffled(spark):
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    for key, value in SHUFFLED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df, capfd):
    capfd.readouterr()
    df.explain()
    return capfd.readouterr().out


def test_hot_product_is_split_and_nothing_is_lost(spark, shuffled, capfd):
    lines = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(" HOT "))
        .otherwise(F.concat(F.lit("item "), F.col("id") % 500)).alias("product_sold"),
        F.sha2(F.col("id").cast("string"), 256).alias("receipt_no"),
    )
    products = spark.range(500).select(
        F.col("id").alias("product_key"),
        F.concat(F.lit("Item "), F.col("id")).alias("product_name"),
        F.lit("c").alias("category"), F.lit(Decimal("1.00")).alias("unit_price_ghs"),
    ).unionByName(spark.createDataFrame(
        [(500, "hot", "c", Decimal("1.00"))],
        "product_key bigint, product_name string, category string, unit_price_ghs decimal(10,2)"))
    matched = match_products(lines, products)
    rows = matched.collect()
    assert len(rows) == 60_000
    assert sum(r["product_key"] == 500 for r in rows) == 20_000
    assert len({r["receipt_no"] for r in rows}) == 60_000
    assert "skew=true" in final_plan(matched, capfd)


def test_hot_flagged_receipt_is_excluded_by_a_shuffled_anti_join(spark, shuffled, capfd):
    lines = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string"))
        .alias("receipt_no"),
        F.sha2(F.col("id").cast("string"), 256).alias("product_sold"),
    )
    flagged = spark.createDataFrame([("",), ("1",)], "receipt_no string")
    left = without_flagged(lines, flagged)
    assert len(left.collect()) == 39_999
    assert "skew=true" in final_plan(left, capfd)
