import random
from decimal import Decimal

import data
import pytest
from tidemark.functions.columns import scaled_price, shifted_quantity
from tidemark.operators import merge


def test_upsert_replaces_inserts_and_keeps(spark):
    held = data.orders(spark, data.order(1, "2025-01-01"), data.order(2, "2025-01-01"))
    batch = data.orders(spark, data.order(2, "2025-01-02", "20.00"), data.order(3, "2025-01-02"))
    found = merge.upsert(held, batch, "order_id")
    assert data.values(found, "order_id", "price") == [
        (1, Decimal("10.00")),
        (2, Decimal("20.00")),
        (3, Decimal("10.00")),
    ]


def test_latest_version_in_a_batch_wins(spark):
    people = data.customers(
        spark,
        (1, "old", "2025-01-01", "2025-01-01"),
        (1, "new", "2025-01-01", "2025-01-03"),
        (2, "tie", "2025-01-01", "2025-01-01"),
    )
    tie = people.where("name = 'tie'").selectExpr("*", "'INSERT' AS change_type").unionByName(
        people.where("name = 'tie'").selectExpr("* EXCEPT (name)", "'later' AS name",
                                                "'UPDATE' AS change_type"))
    feed = people.where("customer_id = 1").selectExpr("*", "'INSERT' AS change_type").unionByName(tie)
    found = merge.latest_per_key(feed, "customer_id")
    assert data.values(found, "customer_id", "name") == [(1, "new"), (2, "later")]


def test_older_rows_replace_unless_asked_not_to(spark):
    held = data.orders(spark, data.order(1, "2025-01-05", "5.00"))
    batch = data.orders(spark, data.order(1, "2025-01-02", "2.00"), data.order(2, "2025-01-01"))
    always = merge.upsert(held, batch, "order_id")
    newer = merge.upsert(held, batch, "order_id", only_newer=True)
    assert data.values(always, "order_id", "price")[0] == (1, Decimal("2.00"))
    assert data.values(newer, "order_id", "price") == [(1, Decimal("5.00")), (2, Decimal("10.00"))]


def test_new_column_is_null_in_old_rows(spark):
    held = data.orders(spark, data.order(1, "2025-01-01"))
    batch = data.orders(spark, data.order(2, "2025-01-02")).selectExpr("*", "'web' AS channel")
    found = merge.upsert(held, batch, "order_id")
    assert data.values(found, "order_id", "channel") == [(1, None), (2, "web")]


def test_native_merge_is_left_to_the_format(spark, lake):
    """Parquet has no MERGE; the statement resolves and is refused for that reason only."""
    name = f"{lake.database}.plain"
    data.orders(spark, data.order(1, "2025-01-01")).write.saveAsTable(name)
    batch = data.orders(spark, data.order(1, "2025-01-02"))
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge.merge_into(batch, name, "order_id")


def test_known_email_is_ignored_and_null_is_not_equal(spark):
    held = data.customers(spark, (1, "ann", "2025-01-01", "2025-01-01"))
    offered = data.customers(
        spark,
        (2, "ann", "2025-01-02", "2025-01-02"),
        (4, "bob", "2025-01-02", "2025-01-02"),
        (3, "bob", "2025-01-02", "2025-01-02"),
        (5, "cem", "2025-01-02", "2025-01-02"),
        (6, "cem", "2025-01-02", "2025-01-02"),
    )
    offered = offered.selectExpr(
        "* EXCEPT (email)", "CASE WHEN name <> 'cem' THEN email END AS email"
    )
    found = merge.insert_ignore(held, offered, "email", "customer_id")
    assert data.values(found, "customer_id") == [(1,), (3,), (5,), (6,)]


def test_keyed_update_sets_null_and_restamps_only_hits(spark):
    held = data.orders(spark, data.order(1, "2025-01-01"), data.order(2, "2025-01-01"))
    changes = spark.createDataFrame([(2, None), (9, "no")], "order_id INT, product_name STRING")
    found = merge.keyed_update(held, changes, "order_id", "2025-02-01 00:00:00")
    assert found.columns == held.columns
    assert data.values(found, "order_id", "product_name", "updated_at") == [
        (1, "lamp", data.at("2025-01-01")),
        (2, None, data.at("2025-02-01")),
    ]


def test_update_expressions(spark):
    sold = data.orders(spark, (1, 1, "lamp", 1, "10.05", "2025-01-01"))
    found = sold.select(shifted_quantity(-1).alias("q"), scaled_price("0.900").alias("p")).first()
    assert (found.q, found.p) == (1, Decimal("9.05"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_in_order_leave_the_latest_row_per_key(spark, seed):
    """Any split of a change log into batches ends in the same rows, also when replayed."""
    draw = random.Random(seed)
    log = [
        data.order(draw.randint(1, 12), f"2025-01-{day:02d}T{hour:02d}:00", f"{draw.randint(1, 99)}.00")
        for day in range(1, 11)
        for hour in range(4)
    ]
    want = {}
    for row in log:
        want[row[0]] = (row[0], Decimal(row[4]), data.at(row[5]))
    held = data.orders(spark).limit(0)
    while log:
        n = draw.randint(1, 15)
        batch, log = data.orders(spark, *log[:n]), log[n:]
        held = merge.upsert(held, batch, "order_id")
        if draw.random() < 0.5:
            held = merge.upsert(held, batch, "order_id")
        held = spark.createDataFrame(held.collect(), data.ORDER)
    assert data.values(held, "order_id", "price", "updated_at") == sorted(want.values(), key=repr)
