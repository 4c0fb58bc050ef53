"""Referential integrity of the fact, and accounting for every sales line."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstar import fixed_values as fixed
from tillstar.functions import norm_key, trimmed
from tillstar.operators.fact import Dimensions, fact_columns

OUTCOMES = ("quarantined", "flagged_receipt", "no_product", "no_store", "no_staff", "no_date",
            "in_fact")


def orphan_keys(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values (NULL included) of the fact that the dimension lacks, with their rows.

    The fact is counted per key before the join, so the join sees each key once.
    """
    return (
        fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
        .join(dimension.select(key).distinct(), key, "left_anti")
    )


def orphan_counts(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan rows of all four foreign keys in one pass over the fact.

    ``dimensions`` maps a key column to its dimension. Each fact row yields its
    four (check, key) pairs; they are counted map-side, so what is shuffled and
    joined is one row per key value, however skewed the fact is. A check without
    orphans is reported with 0.
    """
    pairs = fact.select(F.explode(F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.col(key).cast("bigint").alias("key_value"))
        for check, key in fixed.ORPHAN_CHECKS.items()
    ])).alias("pair")).select("pair.*")
    used = pairs.groupBy("check_name", "key_value").agg(F.count(F.lit(1)).alias("fact_rows"))
    known = reduce(DataFrame.unionByName, [
        dimensions[key].select(F.lit(check).alias("check_name"),
                               F.col(key).cast("bigint").alias("key_value"))
        for check, key in fixed.ORPHAN_CHECKS.items()
    ]).distinct()
    orphans = used.join(known, ["check_name", "key_value"], "left_anti")
    totals = orphans.agg(*[
        F.coalesce(F.sum(F.when(F.col("check_name") == check, F.col("fact_rows"))), F.lit(0))
        .alias(check)
        for check in fixed.ORPHAN_CHECKS
    ])
    return totals.unpivot([], list(fixed.ORPHAN_CHECKS), "check_name", "orphan_count").orderBy(
        "check_name"
    )


def observed_fact(traced: DataFrame, observation: Observation) -> DataFrame:
    """The fact rows of ``trace_lines``; ``observation`` counts all outcomes in the same pass.

    Tasks that run again after a lost executor may be observed twice, so the counts are
    to be compared with the rows written.
    """
    counts = [
        F.count_if((F.col("outcome") == o) & F.col("is_line")).alias(o) for o in OUTCOMES[1:]
    ]
    rows = F.count_if(F.col("outcome") == "in_fact").alias("fact_rows")
    return fact_columns(traced.observe(observation, *counts, rows).filter(
        F.col("outcome") == "in_fact"))


def row_outcomes(
    kept: DataFrame,
    rejected: DataFrame,
    flagged: DataFrame,
    dims: Dimensions,
    path: str,
) -> DataFrame:
    """What became of every raw sales line: exactly one outcome each.

    ``source_rows`` sums to the raw rows; ``fact_rows`` sums to the fact, and
    exceeds the source rows of ``in_fact`` by the fan-out of repeated names.
    Dimensions are reduced to one counted row per matching key, so no join here
    can multiply a line. These lookups are written under ``path``: their sizes are
    known, and a hot product or receipt can be split in the join.
    """
    def lookup(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    products = lookup("products", dims.products.groupBy(
        norm_key("product_name").alias("p_name")).agg(F.count(F.lit(1)).alias("p_rows")))
    stores = lookup("stores", dims.stores.groupBy(
        trimmed("store_id").alias("s_id")).agg(F.count(F.lit(1)).alias("s_rows")))
    staff = lookup("staff", dims.staff.groupBy(
        norm_key("full_name").alias("e_name"), trimmed("store_id").alias("e_store")
    ).agg(F.count(F.lit(1)).alias("e_rows")))
    dates = lookup("dates", dims.dates.groupBy(
        F.col("full_date").alias("d_date")).agg(F.count(F.lit(1)).alias("d_rows")))
    marks = lookup("flagged", flagged.select(F.col("receipt_no").alias("f_receipt")).distinct())

    same_store = trimmed("store_id")
    traced = (
        kept.join(marks, F.col("receipt_no") == F.col("f_receipt"), "left")
        .join(products, norm_key("product_sold") == F.col("p_name"), "left")
        .join(stores, same_store == F.col("s_id"), "left")
        .join(staff, (norm_key("staff_name") == F.col("e_name"))
              & (same_store == F.col("e_store")), "left")
        .join(dates, F.to_date("transaction_date") == F.col("d_date"), "left")
    )
    outcome = (
        F.when(F.col("f_receipt").isNotNull(), "flagged_receipt")
        .when(F.col("p_rows").isNull(), "no_product")
        .when(F.col("s_rows").isNull(), "no_store")
        .when(F.col("e_rows").isNull(), "no_staff")
        .when(F.col("d_rows").isNull(), "no_date")
        .otherwise("in_fact")
    )
    lines = traced.select(
        outcome.alias("outcome"),
        F.lit(1).cast("bigint").alias("source_rows"),
        (F.col("p_rows") * F.col("s_rows") * F.col("e_rows") * F.col("d_rows"))
        .alias("fact_rows"),
    ).unionByName(rejected.select(
        F.lit("quarantined").alias("outcome"),
        F.col("copies").alias("source_rows"),
        F.lit(None).cast("bigint").alias("fact_rows"),
    ))
    by_outcome = lines.groupBy("outcome").agg(
        F.sum("source_rows").alias("source_rows"),
        F.sum(F.when(F.col("outcome") == "in_fact", F.col("fact_rows")).otherwise(0))
        .alias("fact_rows"),
    )
    return _with_every_outcome(by_outcome)


def _with_every_outcome(by_outcome: DataFrame) -> DataFrame:
    """Outcomes that no line had appear with 0 rows."""
    every = by_outcome.sparkSession.createDataFrame(
        [(o, 0, 0) for o in OUTCOMES], "outcome string, source_rows bigint, fact_rows bigint"
    )
    return (
        every.unionByName(by_outcome).groupBy("outcome")
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("fact_rows").alias("fact_rows"))
    )
