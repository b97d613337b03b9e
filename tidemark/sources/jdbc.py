"""Parallel table reads over JDBC."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.increments import Mark


def scan_options(
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 16,
    fetch_rows: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Reader options: split by key range when the bounds are known, else one task."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
        **connection,
    }
    if key and bounds and None not in bounds:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def mark_condition(mark: Mark | None, key: str) -> str | None:
    """A condition in the database's SQL that all rows past the mark meet."""
    if mark is None:
        return None
    if mark.updated_at is None:
        return None if mark.unstamped_key is not None else f"{key} > {_literal(mark.key)}"
    return f"(updated_at >= '{mark.updated_at}' OR updated_at IS NULL)"


def bounds_query(table: str, key: str, where: str | None = None) -> str:
    return f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}" + (f" WHERE {where}" if where else "")


def hash_predicates(key: str, partitions: int, hashed: str = "hashtext({key}::text)") -> list[str]:
    """Conditions that deal rows out by a hash of their key, for keys without ranges.

    ``hashed`` is the database's hash as an integer; the default is PostgreSQL's.
    """
    value = f"MOD({hashed.format(key=key)}, {partitions})"
    return [
        f"{value} IN ({i}, {i - partitions})" + (f" OR {key} IS NULL" if i == 0 else "")
        for i in range(partitions)
    ]


def key_bounds(
    spark: SparkSession, url: str, table: str, key: str, where: str | None = None, **connection: str
) -> tuple:
    """Lowest and highest key, computed by the database; one row comes back."""
    options = {"url": url, "query": bounds_query(table, key, where), **connection}
    return tuple(spark.read.format("jdbc").options(**options).load().first())


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    partitions: int = 16,
    where: str | None = None,
    **connection: str,
) -> DataFrame:
    """All columns of a table, read in key ranges, or by key hash if keys are no numbers.

    Filters put on the result, such as the watermark predicate, are pushed down to the
    database by Spark. ``where`` says which rows that will be, such as
    :func:`mark_condition`, so that the ranges cut these evenly and not the table.
    """
    bounds = key_bounds(spark, url, table, key, where, **connection)
    if any(isinstance(b, str) for b in bounds):
        options = scan_options(url, table, **connection)
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, table, predicates=hash_predicates(key, partitions), properties=rest)
    options = scan_options(url, table, key, bounds, partitions, **connection)
    return spark.read.format("jdbc").options(**options).load()


def _literal(value: Any) -> str:
    text = str(value)
    return text if text.lstrip("-").isdigit() else "'" + text.replace("'", "''") + "'"
