"""Audit and date-part columns that every lake row carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("etl_processed_at", "etl_job_run_id")


def with_audit(df: DataFrame, as_of: str | datetime, run_id: str) -> DataFrame:
    """Stamp the processing time and the run id, both given, so no job is needed."""
    return df.withColumns(
        {
            "etl_processed_at": F.lit(str(as_of)).cast("timestamp"),
            "etl_job_run_id": F.lit(run_id),
        }
    )


def with_date_parts(df: DataFrame) -> DataFrame:
    """Year, month and day of ``updated_at``, or of the processing time without it."""
    stamp = F.col("updated_at" if "updated_at" in df.columns else "etl_processed_at")
    return df.withColumns(
        {"year": F.year(stamp), "month": F.month(stamp), "day": F.dayofmonth(stamp)}
    )


def prepared(df: DataFrame, as_of: str | datetime, run_id: str) -> DataFrame:
    """The rows as the lake stores them."""
    return with_date_parts(with_audit(df, as_of, run_id))
