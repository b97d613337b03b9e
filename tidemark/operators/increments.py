"""Readers for what changed in a source since the last run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from tidemark.functions.columns import day_of, minus, ntz
from tidemark.operators.merge import latest_per_key

Moment = str | date | datetime

# Ranges that are counted in a pass, and rows that are left to a sort.
RANGES = 1_024
SORTED_ROWS = 100_000


@dataclass(frozen=True)
class Mark:
    """The last row read from a source: its ``updated_at`` (if any) and its key.

    ``unstamped_key`` is the highest key read so far among rows without a stamp, which
    have no place in the order of stamps.
    """

    updated_at: str | None
    key: Any
    unstamped_key: Any = None

    def after(self, earlier: Mark | None) -> Mark:
        """This mark, but never behind the one before it."""
        if earlier is None:
            return self
        held = earlier.unstamped_key
        known = [k for k in (held, self.unstamped_key) if k is not None]
        # A stored key comes back as text; it takes the type of the new one.
        kind = type(self.unstamped_key if self.unstamped_key is not None else held)
        unstamped = max(map(kind, known)) if known else None
        same = type(self.key)
        here = (self.updated_at or "", self.key)
        there = (earlier.updated_at or "", same(earlier.key))
        later = self if here >= there else earlier
        return Mark(later.updated_at, later.key, unstamped)


def after_mark(
    df: DataFrame, mark: Mark | None, key: str, lookback: str | None = None
) -> DataFrame:
    """Rows past the mark in ``(updated_at, key)`` order; all rows without a mark.

    Rows without a stamp are read once, in the order of their keys. With a
    ``lookback`` such as ``2 hours``, stamped rows from so long before the mark are
    read again, for those that were committed late.

    The leading bound on ``updated_at`` is implied by the rest. It is stated on
    its own because row-group statistics and database indexes can use it.
    """
    if mark is None:
        return df
    kind = df.schema[key].dataType
    last_key = F.lit(mark.key).cast(kind)
    if "updated_at" not in df.columns:
        return df.where(F.col(key) > last_key)
    stamp = F.col("updated_at")
    unstamped = stamp.isNull()
    if mark.unstamped_key is not None:
        unstamped = unstamped & (F.col(key) > F.lit(mark.unstamped_key).cast(kind))
    if mark.updated_at is None:
        return df.where(stamp.isNotNull() | unstamped)
    last = ntz(mark.updated_at)
    if lookback is not None:
        return df.where((stamp >= minus(mark.updated_at, lookback)) | unstamped)
    return df.where(((stamp >= last) & ((stamp > last) | (F.col(key) > last_key))) | unstamped)


def late_rows(df: DataFrame, mark: Mark, key: str, lookback: str, unique: bool = False) -> DataFrame:
    """Stamped rows up to the mark that a ``lookback`` reads again, without unstamped ones.

    Of a key that repeats, only a row with its last stamp counts, which may lie behind the
    mark; keys known to be ``unique`` are not looked at.
    """
    stamp, last = F.col("updated_at"), ntz(mark.updated_at)
    recent = df.where(stamp >= minus(mark.updated_at, lookback))
    if not unique:
        recent = latest_per_key(recent, key)
    last_key = F.lit(mark.key).cast(df.schema[key].dataType)
    return recent.where((stamp < last) | ((stamp == last) & (F.col(key) <= last_key)))


@dataclass(frozen=True)
class Summary:
    """What one pass over a batch tells."""

    rows: int
    low_key: Any
    high_key: Any
    mark: Mark | None
    repeated: bool
    # Numbers of the partitions that a merge of the batch changed; None stands for all.
    touched: frozenset[int] | None = None
    # The name of the staged copy that is merged.
    staged: str | None = None

    @staticmethod
    def empty() -> Summary:
        return Summary(0, None, None, None, False, frozenset())


def summarize(df: DataFrame, key: str, unique: bool = False) -> Summary:
    """Size, key range and mark of a batch, and whether any key repeats in it.

    Only the key and ``updated_at`` are read. Keys known to be ``unique`` are not
    shuffled to look for repeats.
    """
    stamped = "updated_at" in df.columns
    stamp = F.col("updated_at") if stamped else F.lit(None)
    bare = F.when(F.lit(stamped) & stamp.isNull(), F.col(key))
    keyed = df.select(key, stamp.alias("at"), bare.alias("bare"), F.lit(1).cast("bigint").alias("n"))
    if not unique:
        keyed = keyed.groupBy(key).agg(
            F.max("at").alias("at"), F.max("bare").alias("bare"), F.sum("n").alias("n")
        )
    row = (
        keyed.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("keys"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            F.max(F.struct("at", key)).alias("last"),
            F.max("bare").alias("bare"),
        )
        .withColumns({"at": F.col("last.at").cast("string"), "at_key": F.col(f"last.`{key}`")})
        .first()
    )
    if not row["rows"]:
        return Summary.empty()
    mark = Mark(row["at"], row["at_key"], row["bare"])
    return Summary(row["rows"], row["low"], row["high"], mark, row["rows"] > row["keys"])


def observed(df: DataFrame, key: str) -> tuple[DataFrame, Callable[[], Summary | None]]:
    """A batch of keys that do not repeat, and its summary once an action has read it.

    The figures come from the action's own tasks, each counted once however often it
    was tried, so no second pass is needed. It tells nothing if the plan was found to
    be empty without reading.
    """
    stamp = F.col("updated_at") if "updated_at" in df.columns else F.lit(None).cast("string")
    bare = F.when(stamp.isNull(), F.col(key)) if "updated_at" in df.columns else F.lit(None).cast(df.schema[key].dataType)
    last = F.max(F.struct(stamp.alias("at"), F.col(key).alias("key")))
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"),
        last["at"].cast("string").alias("at"), last["key"].alias("at_key"), F.max(bare).alias("bare"),
    )

    def summary() -> Summary | None:
        found = seen.get
        if "rows" not in found:
            return None
        if not found["rows"]:
            return Summary.empty()
        return Summary(found["rows"], found["low"], found["high"], Mark(found["at"], found["at_key"], found["bare"]), False)

    return watched, summary


def high_mark(df: DataFrame, key: str) -> Mark | None:
    """The mark after reading all rows of ``df``; None if it has no rows."""
    return summarize(df, key, unique=True).mark


def changed_customers(df: DataFrame, since: Moment) -> DataFrame:
    """Customers created or updated after ``since``."""
    return df.where((F.col("created_at") > ntz(since)) | (F.col("updated_at") > ntz(since)))


def changed_orders(df: DataFrame, since: Moment, as_of: Moment, days: int = 7) -> DataFrame:
    """Orders dated since the last run within the recent days, or updated after it."""
    recent = (F.col("order_date") >= day_of(since)) & (
        F.col("order_date") >= F.date_sub(day_of(as_of), days)
    )
    return df.where(recent | (F.col("updated_at") > ntz(since)))


def backfill_or_since(
    df: DataFrame, since: Moment | None, as_of: Moment, days: int = 30
) -> DataFrame:
    """The last ``days`` days on the first run, later on the rows updated since."""
    if since is None:
        return df.where(F.col("updated_at") >= minus(as_of, f"{days} days"))
    return df.where(F.col("updated_at") > ntz(since))


def micro_batch(df: DataFrame, mark: Mark | None, key: str, size: int = 10_000) -> DataFrame:
    """The next ``size`` rows past the mark, in ``(updated_at, key)`` order; unstamped rows come first.

    Key order breaks ties of ``updated_at``; together with the mark this leaves
    no row behind when equal timestamps straddle the cut. Rows that share stamp and key
    with the last one come with it, as the mark could not tell them apart.

    The last row is found by counting, so no task gets the batch or sorts it.
    """
    rest = after_mark(df, mark, key)
    last = kth_row(rest, key, size)
    if last is None:
        return rest
    stamp, last_key = F.col("updated_at"), F.lit(last["key"]).cast(df.schema[key].dataType)
    if last["at"] is None:
        return rest.where(stamp.isNull() & (F.col(key) <= last_key))
    at = F.lit(last["at"]).cast(df.schema["updated_at"].dataType)
    return rest.where(stamp.isNull() | (stamp < at) | ((stamp == at) & (F.col(key) <= last_key)))


def kth_row(df: DataFrame, key: str, k: int) -> Row | None:
    """``at`` (as text) and ``key`` of the k-th row by ``updated_at``, nulls first, then key; None if all rows come before.

    Rows are counted by equal ranges of the stamp, the range in which the k-th lies is
    cut again, and so on; where one stamp has many rows, the same is done with integer
    keys. Each pass reads the two columns and returns a count for each of ``RANGES``
    ranges. Only rows of the last range are sorted, at most ``SORTED_ROWS``, or those that
    share a stamp where keys are no integers. A stamp that is no date or timestamp has no
    ranges, and all rows are sorted.
    """
    inside, left = df.select(F.col("updated_at").alias("at"), F.col(key).alias("key")), k
    total, bare = inside.agg(F.count(F.lit(1)), F.count_if(F.col("at").isNull())).first()
    if total <= k:
        return None
    ticks = _ticks(inside, "at")
    if bare >= k:
        inside, held = inside.where("at IS NULL"), bare
    else:
        inside, held, left = inside.where("at IS NOT NULL"), total - bare, k - bare
        if ticks is not None:
            inside, held, left = _crossing(inside, ticks, held, left)
    # More rows than are sorted have one stamp now, or none.
    if (bare >= k or ticks is not None) and isinstance(inside.schema["key"].dataType, IntegralType):
        inside, held, left = _crossing(inside, F.col("key").cast("bigint"), held, left)
    ordered = inside.orderBy(F.asc_nulls_first("at"), F.asc_nulls_first("key"))
    return ordered.offset(left - 1).limit(1).select(F.col("at").cast("string").alias("at"), "key").first()


def _crossing(rows: DataFrame, place: Column, held: int, left: int) -> tuple[DataFrame, int, int]:
    """The rows whose places share a range with the ``left``-th, how many, and which of them it is.

    Ends with few rows or a single place.
    """
    if held <= SORTED_ROWS:
        return rows, held, left
    low, high = rows.agg(F.min(place), F.max(place)).first()
    while held > SORTED_ROWS and low < high:
        width = -(-(high - low + 1) // RANGES)
        part = F.expr(f"CAST({low} AS BIGINT)")
        counts = rows.groupBy(F.floor((place - part) / F.lit(width)).alias("part")).count().orderBy("part").collect()
        for row in counts:
            if left <= row["count"]:
                break
            left -= row["count"]
        held = row["count"]
        low, high = low + row["part"] * width, min(high, low + (row["part"] + 1) * width - 1)
        rows = rows.where(place.between(low, high))
    return rows, held, left


def _ticks(df: DataFrame, column: str) -> Column | None:
    """A stamp as a whole number in its order, as far as its type has one."""
    kind, stamp = df.schema[column].dataType, F.col(column)
    if isinstance(kind, TimestampType):
        return F.unix_micros(stamp)
    if isinstance(kind, DateType):
        return F.unix_date(stamp).cast("bigint")
    if isinstance(kind, TimestampNTZType):
        seconds = (F.unix_date(F.to_date(stamp)).cast("bigint") * 24 + F.hour(stamp)) * 60 + F.minute(stamp)
        micros = F.date_part(F.lit("SECOND"), stamp) * 1_000_000
        return seconds * 60_000_000 + micros.cast("bigint")
    return None


def change_feed(inserts: DataFrame, updates: DataFrame, since: Moment) -> DataFrame:
    """Inserted and updated rows after ``since``, tagged with their change type."""
    new = inserts.where(F.col("created_at") > ntz(since))
    changed = updates.where(F.col("updated_at") > ntz(since))
    return new.withColumn("change_type", F.lit("INSERT")).unionByName(
        changed.withColumn("change_type", F.lit("UPDATE"))
    )


def recent_orders(df: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Orders dated within the last ``days`` days."""
    return df.where(F.col("order_date") >= F.date_sub(day_of(as_of), days))
