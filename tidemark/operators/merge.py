"""Keyed changes as DataFrame operators: upsert, insert-ignore, update."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz


def latest_per_key(df: DataFrame, key: str, repeated_only: bool = False) -> DataFrame:
    """One row per key: the latest ``updated_at``, an update before an insert.

    All other columns break remaining ties, so a recomputed task picks the same
    row. The maximum is aggregated before the shuffle, so a key with very many
    versions sends one row per input task. ``repeated_only`` leaves out keys with
    a single row.
    """
    order = [c for c in ("updated_at", "change_type") if c in df.columns]
    rest = [c for c in df.columns if c not in order and c != key]
    # The marker keeps the structure valid for a table of nothing but keys.
    best = F.max(F.struct(*order, *rest, F.lit(1).alias("_marker"))).alias("best")
    found = df.groupBy(key).agg(best, F.count(F.lit(1)).alias("_versions"))
    if repeated_only:
        found = found.where(F.col("_versions") > 1)
    return found.select(key, "best.*").select(*df.columns)


def without_stale(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows not older than the target's; keys must be unique in both.

    Only the source's matches leave the first join, so a small source never makes
    the target shuffle.
    """
    held = target.select(key, F.col("updated_at").alias("held_at"))
    stale = (
        held.join(source.select(key, "updated_at"), key)
        .where(F.col("held_at") > F.col("updated_at"))
        .select(key)
    )
    return source.join(stale, key, "left_anti")


def upsert(
    target: DataFrame, source: DataFrame, key: str, only_newer: bool = False
) -> DataFrame:
    """Target rows without a match, and the latest source row of every key.

    Columns only one side has become NULL in the rows of the other.
    """
    latest = latest_per_key(source, key)
    if only_newer:
        latest = without_stale(latest, target, key)
    kept = target.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def merge_into(batch: DataFrame, table: str, key: str) -> None:
    """Upsert into a catalog table whose format has a MERGE of its own, such as Delta."""
    held = table.split(".")[-1]
    match = F.expr(f"{held}.`{key}` = fresh.`{key}`")
    (
        latest_per_key(batch, key)
        .alias("fresh")
        .mergeInto(table, match)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def first_per_value(df: DataFrame, unique: str, key: str) -> DataFrame:
    """Of the rows with one value, that with the lowest key; rows without a value all stay."""
    rest = [c for c in df.columns if c not in (key, unique)]
    first = (
        df.where(F.col(unique).isNotNull())
        .groupBy(unique)
        .agg(F.min(F.struct(key, *rest)).alias("first"))
        .select(unique, "first.*")
    )
    return first.select(*df.columns).unionByName(df.where(F.col(unique).isNull()))


def insert_ignore(target: DataFrame, source: DataFrame, unique: str, key: str) -> DataFrame:
    """Add source rows whose unique value is new; of several, the lowest key wins.

    NULL never equals NULL, so rows without a value all go in.
    """
    # Only the target's rows of offered values reach the anti join, so a small source
    # never makes the target shuffle.
    offered = source.select(unique).where(F.col(unique).isNotNull())
    taken = target.select(unique).join(offered, unique, "left_semi").distinct()
    fresh = first_per_value(source, unique, key).join(taken, unique, "left_anti")
    return target.unionByName(fresh)


def keyed_update(
    target: DataFrame, changes: DataFrame, key: str, as_of: str | datetime
) -> DataFrame:
    """Set the columns of ``changes`` on the rows with its keys and restamp them."""
    columns = [c for c in changes.columns if c != key]
    new = latest_per_key(changes, key).select(
        key, F.struct(*columns).alias("new"), F.lit(True).alias("hit")
    )
    joined = target.join(new, key, "left")
    hit = F.col("hit")

    def value(column: str):
        if column in columns:
            return F.when(hit, F.col(f"new.`{column}`")).otherwise(F.col(column)).alias(column)
        if column == "updated_at":
            return F.when(hit, ntz(as_of)).otherwise(F.col(column)).alias(column)
        return F.col(column)

    return joined.select(*[value(c) for c in target.columns])
