"""The given tables as the customers and orders the reports expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _email(name: str) -> Column:
    return F.concat(F.lower(F.replace(F.col(name), F.lit("#"), F.lit("."))), F.lit("@example.com"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer; a third each changed never, one and two days after creation."""
    key = F.col("c_custkey")
    first = F.lit("1995-01-01").cast("date")
    age = (key % 365).cast("int")
    lag = (key % 3).cast("int")
    return given(spark, folder, "customer").select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        _email("c_name").alias("email"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.date_add(first, age).cast("timestamp_ntz").alias("created_at"),
        F.date_add(first, age + lag).cast("timestamp_ntz").alias("updated_at"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item; ``order_id`` repeats, so this is for reports only."""
    lines = given(spark, folder, "lineitem")
    heads = given(spark, folder, "orders")
    parts = given(spark, folder, "part")
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("p_name").alias("product_name"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_shipdate").alias("updated_at"),
        )
    )


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order; ``order_id`` is unique, as the keyed operators need."""
    return given(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("product_name"),
        F.lit(1).alias("quantity"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderdate").alias("updated_at"),
    )


def supplier_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers in the shape of new customers, with keys no customer has."""
    stamp = F.lit("1996-01-02").cast("timestamp_ntz")
    return given(spark, folder, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("customer_id"),
        F.col("s_name").alias("name"),
        _email("s_name").alias("email"),
        F.lit(None).cast("string").alias("customer_segment"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )
