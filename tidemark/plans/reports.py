"""The sales reports.

Sums are exact decimals; averages are doubles made from exact sums. Orders are
aggregated per customer before they meet the customers, so a customer with very
many orders reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.functions.columns import (
    change_status,
    count_valued,
    exact_average,
    minus,
    order_value,
)
from tidemark.operators.increments import Moment
from tidemark.operators.ranking import latest_rows


def _per_customer(orders: DataFrame) -> DataFrame:
    """Per customer: orders, priced lines, spending and order dates."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        count_valued().alias("valued"),
        F.sum(order_value()).alias("spent"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def _customer_totals(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer, with zero orders where there are none.

    The last grouping only has work to do if a customer row is repeated. It needs
    no further shuffle, as the join has already placed rows by customer.
    """
    joined = customers.select("customer_id", "name", "email").join(
        _per_customer(orders), "customer_id", "left"
    )
    return joined.groupBy("customer_id", "name", "email").agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.sum("spent").alias("total_spent"),
        exact_average(F.sum("spent"), F.sum("valued")).alias("avg_order_value"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
    )


def customer_orders_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return _customer_totals(customers, orders).orderBy(
        F.desc_nulls_last("total_spent"), F.asc("customer_id")
    )


def top_customers(customers: DataFrame, orders: DataFrame, k: int = 5) -> DataFrame:
    return (
        _customer_totals(customers, orders)
        .orderBy(F.desc_nulls_last("total_spent"), F.asc("customer_id"))
        .limit(k)
        .select("name", "email", "total_orders", "total_spent")
    )


def with_distinct(df: DataFrame, groups: list[str], sums: dict[str, Column], key: str, name: str) -> DataFrame:
    """Sums per group, and as ``name`` the exact number of different keys.

    Whole-number keys are marked in bitmaps of ``key`` ranges. Each task makes one bitmap
    for a group and range, and those are shuffled, not a row for each group and key.
    Ranges share no keys, so a group's bits add up. Other keys are counted as they are.
    ``sums`` are aggregates whose parts can be added.
    """
    if not isinstance(df.schema[key].dataType, IntegralType):
        return df.groupBy(*groups).agg(*[c.alias(n) for n, c in sums.items()], F.count_distinct(key).alias(name))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("__bits")
    ranged = df.withColumn("__range", F.bitmap_bucket_number(key))
    parts = ranged.groupBy(*groups, "__range").agg(*[c.alias(n) for n, c in sums.items()], bits)
    kinds = {f.name: f.dataType for f in parts.schema}
    added = [F.sum(n).cast(kinds[n]).alias(n) for n in sums]
    return parts.groupBy(*groups).agg(*added, F.sum(F.bitmap_count("__bits")).alias(name))


def monthly_sales_trend(orders: DataFrame) -> DataFrame:
    sums = {"total_orders": F.count("order_id"), "total_revenue": F.sum(order_value()), "valued": count_valued()}
    months = orders.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    return (
        with_distinct(months, ["year", "month"], sums, "customer_id", "unique_customers")
        .select(
            "year", "month", "total_orders", "total_revenue",
            exact_average(F.col("total_revenue"), F.col("valued")).alias("avg_order_value"), "unique_customers",
        )
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def _per_product(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_name").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum(order_value()).alias("total_revenue"),
        exact_average(F.sum("price"), F.count("price")).alias("avg_price"),
    )


def _best_products(orders: DataFrame, k: int) -> DataFrame:
    return (
        _per_product(orders)
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc("product_name"))
        .limit(k)
    )


def top_products(orders: DataFrame, k: int = 20) -> DataFrame:
    return _best_products(orders, k).withColumnRenamed("total_quantity", "total_quantity_sold")


def top_products_by_revenue(orders: DataFrame, k: int = 5) -> DataFrame:
    return _best_products(orders, k).drop("avg_price")


def customer_count(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count(F.lit(1)).alias("total_customers"))


def order_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count(F.lit(1)).alias("total_orders"))


def total_revenue(orders: DataFrame) -> DataFrame:
    return orders.agg(F.sum(order_value()).alias("total_revenue"))


def customer_lifetime_value(customers: DataFrame, orders: DataFrame) -> DataFrame:
    spending = _per_customer(orders).select("customer_id", "spent", "orders")
    return (
        customers.select("customer_id", "customer_segment")
        .join(spending, "customer_id")
        .groupBy("customer_segment")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            exact_average(F.sum("spent"), F.count("spent")).alias("avg_lifetime_value"),
            exact_average(F.sum("orders"), F.count("orders")).alias("avg_orders_per_customer"),
        )
        .orderBy(F.desc_nulls_last("avg_lifetime_value"), F.asc("customer_segment"))
    )


def monthly_revenue(orders: DataFrame, year: int) -> DataFrame:
    """Revenue per month of one year of a table with ``year`` and ``month`` columns."""
    sums = {"monthly_revenue": F.sum(order_value()), "valued": count_valued()}
    return (
        with_distinct(orders.where(F.col("year") == year), ["year", "month"], sums, "customer_id", "unique_customers")
        .select(
            "year", "month", "monthly_revenue", "unique_customers",
            exact_average(F.col("monthly_revenue"), F.col("valued")).alias("avg_order_value"),
        )
        .orderBy("year", "month")
    )


def recent_changes(
    customers: DataFrame,
    orders: DataFrame,
    customers_as_of: Moment,
    orders_as_of: Moment,
    window: str = "1 hour",
    order_days: int = 1,
) -> DataFrame:
    """How many customers and orders changed lately, in one row."""
    since = minus(customers_as_of, window)
    changed_customers = customers.where(
        (F.col("created_at") >= since) | (F.col("updated_at") >= since)
    )
    first_day = F.date_sub(minus(orders_as_of, "0 days").cast("date"), order_days)
    changed_orders = orders.where(
        (F.col("order_date") >= first_day) | (F.col("updated_at") >= minus(orders_as_of, window))
    )
    counts = changed_customers.agg(F.count(F.lit(1)).alias("recent_customers")).unionByName(
        changed_orders.agg(F.count(F.lit(1)).alias("recent_orders")), allowMissingColumns=True
    )
    return counts.agg(
        F.max("recent_customers").alias("recent_customers"),
        F.max("recent_orders").alias("recent_orders"),
    )


def customer_changes(customers: DataFrame) -> DataFrame:
    """Every customer with its change status."""
    return customers.select("name", "email", change_status().alias("status"), "updated_at")


def latest_changes(
    customers: DataFrame, as_of: Moment, window: str = "1 hour", k: int = 5
) -> DataFrame:
    """The latest customer changes within a window."""
    recent = customers.where(F.col("updated_at") >= minus(as_of, window))
    return customer_changes(latest_rows(recent, "customer_id", k))


# Reports over the customers and orders of a lake, by name.
REPORTS = {
    "customer_orders_summary": customer_orders_summary,
    "monthly_sales_trend": lambda customers, orders: monthly_sales_trend(orders),
    "top_products": lambda customers, orders: top_products(orders),
    "customer_count": lambda customers, orders: customer_count(customers),
    "order_count": lambda customers, orders: order_count(orders),
    "total_revenue": lambda customers, orders: total_revenue(orders),
    "top5_customers": top_customers,
    "top5_products": lambda customers, orders: top_products_by_revenue(orders),
    "customer_lifetime_value": customer_lifetime_value,
}
