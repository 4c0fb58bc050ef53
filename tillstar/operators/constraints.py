"""Data-quality constraints as DataFrame operators.

A row check only fails a row that *definitely* breaks it: like a SQL CHECK, a
NULL outcome passes, and the not-null check is the one that catches NULLs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class ConstraintViolation(ValueError):
    """Rows break constraints for which the load must stop."""


@dataclass(frozen=True)
class RowCheck:
    """``failed`` decides the row, ``shown`` is the value reported for it."""

    name: str
    failed: Column
    shown: Column


def not_null(column: str, shown: str | None = None) -> RowCheck:
    return RowCheck(f"{column}_not_null", F.col(column).isNull(),
                    F.col(shown or column).cast("string"))


def in_range(column: str, low: object, high: object) -> RowCheck:
    return RowCheck(f"{column}_range", ~F.col(column).between(low, high),
                    F.col(column).cast("string"))


def in_domain(column: str, values: Sequence[str]) -> RowCheck:
    return RowCheck(f"{column}_domain", ~F.col(column).isin(*values), F.col(column))


def positive(column: str) -> RowCheck:
    return RowCheck(f"{column}_positive", F.col(column) <= 0, F.col(column).cast("string"))


def _definitely(c: RowCheck) -> Column:
    return F.coalesce(c.failed, F.lit(False))


def passing(df: DataFrame, checks: Iterable[RowCheck]) -> DataFrame:
    """Rows that break no check: one plain filter per check, so each can be pushed down."""
    for c in checks:
        df = df.filter(~_definitely(c))
    return df


def failing(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Rows that break a check, with the names of all they break in ``failed_checks``."""
    broken = df.filter(reduce(Column.__or__, [_definitely(c) for c in checks]))
    return broken.withColumn(
        "failed_checks", F.concat_ws(",", *[F.when(c.failed, F.lit(c.name)) for c in checks])
    )


def violations(df: DataFrame, checks: Sequence[RowCheck], keep: Sequence[str] = ()) -> DataFrame:
    """One row per failed check of a row, with the ``keep`` columns beside it."""
    entries = F.array(*[
        F.when(c.failed, F.struct(F.lit(c.name).alias("check_name"), c.shown.alias("raw_value")))
        for c in checks
    ])
    broken = df.filter(reduce(Column.__or__, [_definitely(c) for c in checks]))
    return (
        broken.select(*keep, F.explode(entries).alias("v"))
        .filter(F.col("v").isNotNull())
        .select(*keep, "v.check_name", "v.raw_value")
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys carried by more than one row, with the number of rows.

    Counts are combined before the shuffle, so a hot key costs one row per task.
    NULL keys are distinct from each other, as in a SQL UNIQUE constraint.
    """
    known = df
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    return (
        known.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def check_counts(
    table: str, df: DataFrame, key: str, checks: Sequence[RowCheck] = ()
) -> DataFrame:
    """(table_name, check_name, rows_checked, failed_rows) of a primary key and row checks.

    A key fails where it is missing (NULL or blank) and where it is repeated, in all rows of
    a key but one. Rows are combined per key before the one shuffle, so a key that very many
    rows share costs one row per task.
    """
    value = F.nullif(F.trim(F.col(key)), F.lit(""))
    per_key = df.groupBy(value.alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_definitely(c)).alias(f"_failed_{i}") for i, c in enumerate(checks)])
    known = F.col("_key").isNotNull()
    failed = {
        f"{key}_not_null": F.sum(F.when(~known, F.col("_rows")).otherwise(0)),
        f"{key}_unique": F.sum(F.when(known, F.col("_rows") - 1).otherwise(0)),
        **{c.name: F.sum(f"_failed_{i}") for i, c in enumerate(checks)},
    }
    total = per_key.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_checked"), *[
        F.coalesce(n, F.lit(0)).alias(name) for name, n in failed.items()])
    found = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failed_rows"))
                      for name in failed])
    return total.select("rows_checked", F.inline(found)).select(
        F.lit(table).alias("table_name"), "check_name", "rows_checked", "failed_rows")


@dataclass(frozen=True)
class UniqueSplit:
    """Rows kept for a composite key, and the surplus rows with their multiplicity."""

    kept: DataFrame
    surplus: DataFrame


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str
) -> UniqueSplit:
    """Keep the first row of each key in ``order``; the others are surplus.

    ``keys`` and ``order`` must cover all columns, so that ties are equal rows
    and the choice is deterministic.

    Repeated keys are rare, so whole rows are not shuffled to find them: one
    narrow pass counts 8-byte digests of the keys and writes those seen more than
    once under ``path``. As a stored table it has a known size, and the planner
    broadcasts it only if that is small. Rows whose digest is unique are kept as
    they are. The rest, every repeated key and any digest collision, is decided
    on the true keys: equal rows collapse into one with ``copies`` before the
    shuffle and the first row is an aggregate, not a window, so a key holding a
    third of all rows never meets in one task. These lines are
    written under ``path`` too, so ``df`` is read three times in all. A key with a NULL is
    no key, as in ``repeated_keys``: its rows are kept.
    """
    digest = F.xxhash64(*keys)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    unkeyed = df.filter(~keyed).select(*keys, *order)
    df = df.filter(keyed)
    repeated = _written(
        df.groupBy(digest.alias("key_digest")).agg(F.count(F.lit(1)).alias("key_rows"))
        .filter(F.col("key_rows") > 1).select("key_digest"), f"{path}/digests")
    same = digest == F.col("key_digest")

    lines = _written(
        df.join(repeated, same, "left_semi")
        .groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("copies")), f"{path}/lines")
    first = F.struct(*order)
    winners = lines.groupBy(*keys).agg(
        F.min(first).alias("first_row"), F.sum("copies").alias("key_rows")
    )
    kept = (
        df.join(repeated, same, "left_anti").select(*keys, *order)
        .unionByName(winners.select(*keys, "first_row.*"))
        .unionByName(unkeyed)
    )
    is_first = first.eqNullSafe(F.col("first_row")).cast("bigint")
    surplus = (
        lines.join(winners.filter(F.col("key_rows") > 1), list(keys))
        .select(*keys, *order, (F.col("copies") - is_first).alias("copies"))
        .filter(F.col("copies") > 0)
    )
    return UniqueSplit(kept, surplus)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def violation_counts(
    df: DataFrame, checks: Sequence[RowCheck], unique: Sequence[str] = ()
) -> DataFrame:
    """(check_name, rows) of everything that breaks ``checks`` or the unique key."""
    counts = (
        violations(df, checks).groupBy("check_name").agg(F.count(F.lit(1)).alias("rows"))
    )
    if unique:
        surplus = repeated_keys(df, unique).agg(F.sum(F.col("copies") - 1).alias("rows"))
        counts = counts.unionByName(
            surplus.filter(F.col("rows") > 0).select(
                F.lit("_".join([*unique, "unique"])).alias("check_name"), "rows"
            )
        )
    return counts


def enforce(
    df: DataFrame,
    table: str,
    checks: Sequence[RowCheck],
    unique: Sequence[str],
    policy: str,
    path: str,
) -> DataFrame:
    """Apply a policy to the constraints of a small typed table.

    ``report`` changes nothing, ``quarantine`` drops the broken rows (the caller
    records ``violations``), ``fail`` raises with the count of every broken check.
    At most one count per check reaches the driver. ``path`` is scratch space.
    """
    if policy == "report":
        return df
    if policy == "quarantine":
        others = [c for c in df.columns if c not in unique]
        sound = passing(df, checks)
        return first_per_key(sound, unique, others, path).kept.select(*df.columns)
    broken = {r["check_name"]: r["rows"] for r in violation_counts(df, checks, unique).collect()}
    if broken:
        raise ConstraintViolation(f"{table}: {broken}")
    return df
