"""Checks of the constraints that the source tables declare."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, in one pass."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    found = F.array(
        *[
            F.struct(F.lit(f"{c} not null").alias("constraint_name"), F.col(c).alias("violations"))
            for c in columns
        ]
    )
    return _named(nulls.select(F.inline(found)), table)


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond the first per value; NULLs do not count as equal."""
    surplus = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
    )
    return _named(surplus.withColumn("constraint_name", F.lit(f"{column} unique")), table)


def references(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Rows that point to no parent row.

    Both sides are reduced to one row per value before the join, so a frequent
    value does not weigh more than others.
    """
    known = parent.select(F.col(parent_key).alias(column)).distinct()
    orphans = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(known, column, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
    )
    return _named(orphans.withColumn("constraint_name", F.lit(f"{column} references")), table)


def keyed(df: DataFrame, table: str, key: str, columns: Sequence[str]) -> DataFrame:
    """NULLs of the key and of other columns, and rows beyond the first per key, in one pass.

    NULLs are counted per key first, so the pass that finds repeated keys carries them.
    """
    rows = F.count(F.lit(1)).alias("n")
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        rows, *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    known = F.col("_key").isNotNull()
    totals = {
        f"{key} not null": F.sum(F.when(~known, F.col("n"))),
        f"{key} unique": F.sum(F.when(known, F.col("n") - 1)),
    } | {f"{c} not null": F.sum(f"_{i}") for i, c in enumerate(columns)}
    counted = per_key.agg(*[F.coalesce(v, F.lit(0)).alias(f"_{i}") for i, v in enumerate(totals.values())])
    found = F.array(
        *[
            F.struct(F.lit(name).alias("constraint_name"), F.col(f"_{i}").alias("violations"))
            for i, name in enumerate(totals)
        ]
    )
    return _named(counted.select(F.inline(found)), table)


def check_constraints(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every declared constraint with its number of violations."""
    checks = [
        keyed(customers, "customers", "customer_id", ["name"]),
        keyed(customers, "customers", "email", []),
        keyed(orders, "orders", "order_id", ["product_name", "quantity", "price"]),
        references(orders, "orders", "customer_id", customers, "customer_id"),
    ]
    return reduce(DataFrame.unionByName, checks)


def _named(df: DataFrame, table: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), "constraint_name", F.col("violations").cast("bigint")
    )
