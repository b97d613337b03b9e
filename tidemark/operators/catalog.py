"""Schema and partition discovery, and table profiles."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemark.sources.files import list_partition_files

# Digits that any value of a whole-number type needs.
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
WHOLE = list(DIGITS)


def read_merged(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder under their merged schema; missing columns are NULL.

    Every footer is read, in parallel, to learn the schema. Use it to discover
    data written elsewhere; tables in the catalog know their schema.
    """
    return spark.read.option("mergeSchema", "true").parquet(folder)


def wider(a: DataType, b: DataType) -> DataType | None:
    """The least type that holds every value of both and that Parquet files of both read as.

    None if there is none, as for text and numbers, or a wide integer and a double.
    """
    if a == b:
        return a
    if type(b) in WHOLE and type(a) in WHOLE:
        return max(a, b, key=lambda t: WHOLE.index(type(t)))
    if isinstance(a, StructType) and isinstance(b, StructType):
        return widened([a, b])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inner = wider(a.elementType, b.elementType)
        return inner and ArrayType(inner)
    for one, other in ((a, b), (b, a)):
        if isinstance(one, DoubleType) and isinstance(other, (FloatType, ByteType, ShortType, IntegerType)):
            return one
        if isinstance(one, FloatType) and isinstance(other, (ByteType, ShortType, IntegerType)):
            return DoubleType()
        if isinstance(one, TimestampNTZType) and isinstance(other, DateType):
            return one
        if isinstance(one, DecimalType) and isinstance(other, (DecimalType, *WHOLE)):
            whole = other.precision - other.scale if isinstance(other, DecimalType) else DIGITS[type(other)]
            scale = max(one.scale, getattr(other, "scale", 0))
            precision = max(one.precision - one.scale, whole) + scale
            return DecimalType(precision, scale) if precision <= 38 else None
    return None


def widened(schemas: list[StructType]) -> StructType:
    """One schema for all: the columns by first appearance, each of its widest type.

    Names are compared without case. Columns of types that have none in common are an error.
    """
    fields: dict[str, StructField] = {}
    for field in (f for schema in schemas for f in schema):
        held = fields.setdefault(field.name.lower(), field)
        both = wider(held.dataType, field.dataType)
        if both is None:
            raise ValueError(
                f"column {held.name} is {held.dataType.simpleString()} in some files and "
                f"{field.dataType.simpleString()} in others"
            )
        fields[field.name.lower()] = StructField(held.name, both)
    return StructType(list(fields.values()))


def physical_schemas(spark: SparkSession, folder: str) -> list[StructType]:
    """The different schemas of the files below a folder, without partition columns, oldest first.

    Schemas change with time: files are halved in the order of their age until those of a
    part merge, and each trial reads the part's footers in parallel. That is one trial
    where no type changed, and some for each change otherwise. What reaches the driver is
    the list of files, as for any read of them.
    """
    files = list_partition_files(spark, folder).select("path", "modificationTime")
    # Of files of one age, those of one write are neighbours, too.
    written = F.regexp_extract("path", "part-[0-9]+-(.*)$", 1)
    paths = [r["path"] for r in files.orderBy("modificationTime", written, "path").select("path").collect()]
    found: list[StructType] = []

    def look(part: list[str]) -> None:
        try:
            schema = spark.read.option("mergeSchema", "true").parquet(*part).schema
        except (PySparkException, Py4JJavaError) as error:
            if len(part) == 1 or "CANNOT_MERGE" not in str(error):
                raise
            look(part[: len(part) // 2])
            look(part[len(part) // 2 :])
            return
        if schema not in found:
            found.append(schema)

    if paths:
        look(paths)
    return found


def read_widened(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder, where a column's type may have changed from file to file.

    Each column has the least type that holds all its values; missing ones are NULL. It is
    one scan, which reads narrower files as the wider type, so filters reach the files.
    """
    schemas = physical_schemas(spark, folder)
    if not schemas:
        return spark.read.parquet(folder)
    parts = _partition_fields(spark, folder)
    return spark.read.schema(StructType(_without(widened(schemas), parts) + parts)).parquet(folder)


def _partition_fields(spark: SparkSession, folder: str) -> list[StructField]:
    """The columns that the folders name."""
    listed = list_partition_files(spark, folder).drop("path", "modificationTime", "length")
    return list(listed.schema)


def _without(schema: StructType, parts: list[StructField]) -> list[StructField]:
    names = {f.name.lower() for f in parts}
    return [f for f in schema if f.name.lower() not in names]


def discover_table(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Register the files below a folder, or bring the table up to date with them.

    New columns are added, columns whose files have a wider type by now are widened, and
    partitions are added or dropped as folders came and went. A table's columns never get
    narrower; a type that has none in common with the table's is an error.
    """
    parts = _partition_fields(spark, folder)
    if not spark.catalog.tableExists(name):
        _register(spark, name, folder, _without(read_widened(spark, folder).schema, parts), parts)
    else:
        known = _without(spark.table(name).schema, parts)
        schema = _without(widened([StructType(known), *physical_schemas(spark, folder)]), parts)
        if any(found.dataType != held.dataType for found, held in zip(schema, known)):
            # A Parquet table in the catalog can't change a type, but its files stay where they are.
            if spark.catalog.getTable(name).tableType != "EXTERNAL":
                raise ValueError(f"{name} is not a table over a folder of its own, so its types can't be widened")
            spark.sql(f"DROP TABLE {name}")
            _register(spark, name, folder, schema, parts)
        elif new := schema[len(known) :]:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
    sync_partitions(spark, name)
    return spark.table(name)


def _register(spark: SparkSession, name: str, folder: str, schema: list[StructField], parts: list[StructField]) -> None:
    """A table over the folder's files; its partition columns are those that the folders name."""
    by = f"PARTITIONED BY ({', '.join(f'`{f.name}`' for f in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {name} ({_ddl(schema + parts)}) USING parquet {by} LOCATION '{folder}'")


def _ddl(fields: list[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def sync_partitions(spark: SparkSession, name: str) -> None:
    """Match the catalog's partitions to the folders, if the table has any."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def table_profile(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """One row per column with its type and the table's row count.

    A missing table is one row with ``found`` false.
    """
    missing = [
        (name, False, None, None, None, None) for name, df in tables.items() if df is None
    ]
    schema = (
        "table_name STRING, found BOOLEAN, position INT, column_name STRING, "
        "data_type STRING, row_count BIGINT"
    )
    profiles = [_profile(name, df) for name, df in tables.items() if df is not None]
    if missing:
        profiles.append(spark.createDataFrame(missing, schema))
    return reduce(DataFrame.unionByName, profiles)


def _profile(name: str, df: DataFrame) -> DataFrame:
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(column).alias("column_name"),
                F.lit(data_type).alias("data_type"),
            )
            for i, (column, data_type) in enumerate(df.dtypes, start=1)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.inline(columns), "row_count")
        .select(
            F.lit(name).alias("table_name"),
            F.lit(True).alias("found"),
            "position",
            "column_name",
            "data_type",
            "row_count",
        )
    )
