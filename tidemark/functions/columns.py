"""Column expressions shared by the operators and the reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("year", "month", "day")


def ntz(value: str | date | datetime) -> Column:
    """A zone-less timestamp literal.

    It goes through text so that neither the Python nor the session zone can
    shift it, and folds to a constant, which keeps comparisons pushable.
    """
    return F.lit(str(value)).cast("timestamp_ntz")


def day_of(value: str | date | datetime) -> Column:
    """The calendar day of a zone-less timestamp literal."""
    return ntz(value).cast("date")


def minus(as_of: str | date | datetime, length: str) -> Column:
    """``as_of`` less an interval such as ``"1 hour"`` or ``"7 days"``."""
    return ntz(as_of) - F.expr(f"INTERVAL {length}")


def order_value() -> Column:
    """``quantity * price``, exact."""
    return F.col("quantity") * F.col("price")


def count_valued() -> Column:
    """How many rows have an order value, without computing it."""
    return F.count_if(F.col("quantity").isNotNull() & F.col("price").isNotNull())


def exact_average(total: Column, n: Column) -> Column:
    """An average from an exact decimal sum; NULL when there is nothing to average."""
    return F.try_divide(total.cast("double"), n)


def change_status() -> Column:
    """UPDATED when a row was changed after it was created, else NEW."""
    return F.when(F.col("updated_at") > F.col("created_at"), "UPDATED").otherwise("NEW")


def updated_name() -> Column:
    return F.concat(F.col("name"), F.lit(" (Updated)"))


def shifted_quantity(delta: int) -> Column:
    """The quantity moved by ``delta``, never below one."""
    return F.greatest(F.lit(1), F.col("quantity") + F.lit(delta))


def scaled_price(factor: str) -> Column:
    """The price times a decimal factor, rounded to cents in decimal arithmetic."""
    return F.round(F.col("price") * F.lit(factor).cast("decimal(4,3)"), 2).cast("decimal(10,2)")


def partition_key() -> Column:
    """``yyyymmdd`` of the partition columns, 0 for rows without a date.

    It uses partition columns only, so a filter on it prunes partitions.
    """
    year, month, day = (F.col(c) for c in PARTITION_COLUMNS)
    return F.coalesce(year * 10000 + month * 100 + day, F.lit(0))
