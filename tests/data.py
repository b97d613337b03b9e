"""Small rows in the shape of the source tables."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

CUSTOMER = "customer_id INT, name STRING, email STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
ORDER = (
    "order_id INT, customer_id INT, product_name STRING, quantity INT, price DECIMAL(10,2), "
    "order_date DATE, updated_at TIMESTAMP_NTZ"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def customers(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (id, name, created, updated); the email follows from the name."""
    return spark.createDataFrame(
        [(i, name, f"{name}@example.com", at(c), at(u)) for i, name, c, u in rows], CUSTOMER
    )


def orders(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (id, customer, product, quantity, price, updated), dated by the update."""
    return spark.createDataFrame(
        [
            (i, c, product, q, Decimal(price), date.fromisoformat(u[:10]), at(u))
            for i, c, product, q, price, u in rows
        ],
        ORDER,
    )


def order(i: int, updated: str, price: str = "10.00", customer: int = 1) -> tuple:
    return (i, customer, "lamp", 1, price, updated)


def values(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
