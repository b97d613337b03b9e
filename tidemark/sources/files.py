"""Listings of the files below a folder, one row per file, and moves of single files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranking import top_per_group

# The file source sizes its tasks by file length although no content is read;
# grouping them keeps a listing of many large files to a few tasks.
LISTING_TASKS = 64


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Path, length and modification time of every file, at any depth.

    The content column is pruned, so no file is opened. Names that start with
    ``_`` or ``.`` are hidden, as in every Spark read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return (
        reader.load(folder).select("path", "length", "modificationTime").coalesce(LISTING_TASKS)
    )


def list_partition_files(
    spark: SparkSession, folder: str, partitions: Sequence[str] | None = None
) -> DataFrame:
    """Like :func:`list_files` for a partitioned table, with its partition columns.

    Only the named ``partitions``, such as ``year=2025/month=1/day=15``, are listed.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    inside = [folder] if partitions is None else [f"{folder}/{p}" for p in partitions]
    return (
        reader.option("basePath", folder)
        .load(inside)
        .drop("content")
        .coalesce(LISTING_TASKS)
    )


def _found(spark: SparkSession, path: str):
    """A path and the file system that it is on, both of the JVM."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def move_files(spark: SparkSession, folder: str, to: str, name: str) -> None:
    """Move a folder's Parquet files to another one of the same file system, as ``name-0`` and so on.

    What is moved already, or not there, is no error, so a move can be repeated.
    """
    there, system = _found(spark, folder)
    if not system.exists(there):
        return
    for status in system.listStatus(there):
        if not (source := status.getPath()).getName().endswith(".parquet"):
            continue
        n = 0
        while system.exists(target := _found(spark, f"{to}/{name}-{n}.parquet")[0]):
            n += 1
        if not system.rename(source, target):
            raise OSError(f"{source} could not be moved to {target}")


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that is never seen in part; False if there is one of this name already.

    It is written under a hidden name and renamed, which fails over an existing file.
    """
    there, system = _found(spark, path)
    hidden, _ = _found(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = system.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    options = spark._jvm.org.apache.hadoop.fs.Options
    no_options = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 0)
    try:
        context.rename(hidden, there, no_options)
        return True
    except Py4JJavaError:
        if not system.exists(there):
            raise
        return False
    finally:
        system.delete(hidden, False)


def remove_file(spark: SparkSession, path: str) -> None:
    there, system = _found(spark, path)
    system.delete(there, False)


def remove_folder(spark: SparkSession, folder: str) -> None:
    there, system = _found(spark, folder)
    system.delete(there, True)


def with_folder(files: DataFrame, root: str) -> DataFrame:
    """Add the top-level folder below ``root``; files directly in it are ``root``."""
    bare = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.element_at(F.split(F.col("path"), f"\\Q{bare}/\\E", 2), 2)
    top = F.when(below.contains("/"), F.split_part(below, F.lit("/"), F.lit(1))).otherwise("root")
    return files.withColumn("folder", top)


def folder_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def total_size(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def newest_files(files: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most recently modified files of each folder."""
    return top_per_group(files, "folder", [F.desc("modificationTime"), F.asc("path")], k)
