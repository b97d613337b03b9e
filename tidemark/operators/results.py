"""Where report results are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_result(df: DataFrame, location: str, name: str) -> str:
    """Store a report under the result location, replacing the one before.

    The files hold the rows of the report, but not their order.
    """
    folder = f"{location.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(folder)
    return folder
