"""Top rows: latest, sampled, and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The ``k`` latest rows by ``updated_at``, or by processing time without it."""
    stamp = "updated_at" if "updated_at" in df.columns else "etl_processed_at"
    return df.orderBy(F.desc_nulls_last(stamp), F.asc(key)).limit(k)


def sample_rows(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows in an order that is random but repeatable for a seed.

    The order is a hash of seed and key, so a recomputed task draws the same rows.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(draw, F.col(key)).limit(k)


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], k: int
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark limits each group before the shuffle as well, so a large group does
    not travel whole to one task.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= k).drop("place")
