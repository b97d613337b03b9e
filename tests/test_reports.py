import pytest
import random
from decimal import Decimal

import data
from tidemark.plans import reports


def test_customer_without_orders_is_kept_and_last(spark):
    people = data.customers(
        spark,
        (1, "ann", "2025-01-01", "2025-01-01"),
        (2, "bob", "2025-01-01", "2025-01-01"),
        (3, "cem", "2025-01-01", "2025-01-01"),
    )
    sold = data.orders(
        spark,
        (1, 1, "lamp", 2, "10.10", "2025-01-03"),
        (2, 2, "desk", 1, "99.99", "2025-01-04"),
        (3, 1, "desk", 1, "0.05", "2025-01-05"),
        (4, 9, "desk", 1, "500.00", "2025-01-05"),
    )
    found = reports.customer_orders_summary(people, sold).collect()
    assert [r.customer_id for r in found] == [2, 1, 3]
    assert found[1].total_spent == Decimal("20.25")
    assert found[1].avg_order_value == 20.25 / 2
    assert (str(found[1].first_order_date), str(found[1].last_order_date)) == (
        "2025-01-03",
        "2025-01-05",
    )
    assert found[2].total_orders == 0
    assert found[2].total_spent is None and found[2].avg_order_value is None


def test_repeated_customer_row_counts_its_orders_twice(spark):
    ann = (1, "ann", "2025-01-01", "2025-01-01")
    people = data.customers(spark, ann, ann)
    sold = data.orders(spark, data.order(1, "2025-01-03"))
    found = reports.customer_orders_summary(people, sold).first()
    assert (found.total_orders, found.total_spent, found.avg_order_value) == (2, 20, 10.0)


def test_null_price_is_left_out_of_sums_and_averages(spark):
    sold = data.orders(spark, data.order(1, "2025-01-03"), data.order(2, "2025-01-03", "30.00"))
    sold = sold.unionByName(sold.limit(1).selectExpr(
        "3 AS order_id", "customer_id", "product_name", "quantity",
        "CAST(NULL AS DECIMAL(10,2)) AS price", "order_date", "updated_at"))
    found = reports.top_products(sold).first()
    assert (found.order_count, found.total_revenue, found.avg_price) == (3, 40, 20.0)
    month = reports.monthly_sales_trend(sold).first()
    assert (month.total_orders, month.avg_order_value) == (3, 20.0)


def test_recent_changes_counts_nothing_on_empty_tables(spark):
    people, sold = data.customers(spark).limit(0), data.orders(spark).limit(0)
    found = reports.recent_changes(people, sold, "2025-01-01", "2025-01-01").first()
    assert tuple(found) == (0, 0)


def test_recent_changes_and_latest(spark):
    people = data.customers(
        spark,
        (1, "ann", "2025-01-01T00:00", "2025-01-01T10:30"),
        (2, "bob", "2025-01-01T10:45", "2025-01-01T10:45"),
        (3, "cem", "2025-01-01T00:00", "2025-01-01T09:59"),
    )
    sold = data.orders(spark, data.order(1, "2024-12-31"), data.order(2, "2024-12-30"))
    now = "2025-01-01 11:00:00"
    assert tuple(reports.recent_changes(people, sold, now, now).first()) == (2, 1)
    found = reports.latest_changes(people, now).collect()
    assert [(r.name, r.status) for r in found] == [("bob", "NEW"), ("ann", "UPDATED")]


def test_month_of_one_year(spark):
    sold = data.orders(spark, data.order(1, "2024-12-31"), data.order(2, "2025-02-01", "3.50"))
    parts = sold.selectExpr("*", "year(updated_at) AS year", "month(updated_at) AS month")
    found = reports.monthly_revenue(parts, 2025).collect()
    assert [(r.year, r.month, r.monthly_revenue) for r in found] == [(2025, 2, Decimal("3.50"))]


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint", "string"])
def test_distinct_customers_by_bitmaps(spark, kind):
    """Ids on both sides of zero and of the ranges' ends, nulls, and months without a customer."""
    draw = random.Random(4)
    ids = [None, 0, 1, -1, 32767, -32767, -32768] + ([32768, 32769, 65536, 65537, -65536, 10**9] if kind != "smallint" else [])
    rows = [(i, draw.choice(ids), draw.randrange(1, 4), draw.choice([None, 1.5, 2.0]), draw.randrange(1, 13)) for i in range(800)]
    rows += [(900, None, 1, 1.0, 13)]
    orders = spark.createDataFrame(rows, "order_id int, customer_id bigint, quantity int, price double, m int").selectExpr(
        "order_id", f"CAST(customer_id AS {kind}) AS customer_id", "quantity", "CAST(price AS DECIMAL(10,2)) AS price",
        "add_months(DATE '2024-12-05', m) AS order_date",
    ).repartition(5)
    got = {(r["year"], r["month"]): (r["total_orders"], r["unique_customers"], r["total_revenue"]) for r in reports.monthly_sales_trend(orders).collect()}
    want = {}
    for _, customer, quantity, price, m in rows:
        at = (2024 + (m + 11) // 12, (m + 11) % 12 + 1)
        n, who, total = want.get(at, (0, set(), None))
        value = None if price is None else quantity * price
        want[at] = (n + 1, who | ({customer} - {None}), value if total is None else total if value is None else total + value)
    assert got == {at: (n, len(who), total) for at, (n, who, total) in want.items()} and got[2026, 1][1] == 0
    plan = reports.monthly_sales_trend(orders)._jdf.queryExecution().executedPlan().toString()
    assert ("bitmap" in plan.lower()) == (kind != "string")
    # Bitmaps are made before the shuffle; no row for each month and customer is.
    assert kind == "string" or not [x for x in plan.splitlines() if "Exchange hash" in x and "customer_id" in x]
