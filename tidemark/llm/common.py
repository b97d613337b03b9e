"""What several operators need: tables, scratch folders, fixed text patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import session_conf, shared_dir

# The space characters of the contracts, and letters folded by them.
SPACES = " \t\n\x0b\x0c\r"
# Rows that a Python worker gets at once: texts can be long.
ARROW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Have this session send Python workers few texts at a time.

    For callers that write a lazy result themselves; what operators store on their way
    comes in small batches anyway.
    """
    for key, value in ARROW_ROWS.items():
        spark.conf.set(key, value)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder, reached by all executors."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, settings: dict[str, str] = ARROW_ROWS) -> DataFrame:
    """The rows written once to the shared folder, under session settings, and read back.

    It cuts lineage: a lost executor costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    with session_conf(spark, settings):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, purpose: str, *measures: Column) -> tuple[DataFrame, list]:
    """The rows as ``stored``, and aggregates of them that their writing brings along.

    Each query that runs leaves its plan with the driver for a long time, so none is run
    for a count alone.
    """
    seen = Observation()
    names = [f"m{i}" for i in range(len(measures))]
    kept = stored(df.observe(seen, *[m.alias(n) for m, n in zip(measures, names)]), purpose)
    found = seen.get
    return kept, [found[n] for n in names]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain ASCII takes the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """Whether no label of the document may be learned: crc32 of its id as text, mod 3, is 1.

    A null id has no remainder and counts as not held out.
    """
    remainder = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3
    return F.coalesce(remainder == 1, F.lit(False))
