import threading
from decimal import Decimal

import data
import pytest
from pyspark.sql import functions as F
from tidemark.operators.increments import Mark
from tidemark.operators.lake import LakeTable
from tidemark.operators.watermarks import Watermarks
from tidemark.plans import incremental
from tidemark.plans.incremental import load_all, load_increment
from tidemark.sources.files import list_files
from tidemark.streaming.landing import load_landed_files

NOW = "2025-08-01 00:00:00"


def test_scenario(spark, lake):
    """Load, change, load again: new and updated rows arrive, nothing else is read."""
    t, marks = lake.table("orders", "order_id"), Watermarks(lake)
    source = data.orders(spark, *[data.order(i, f"2025-01-{10 + i}") for i in range(1, 6)])
    first = load_increment(t, source, NOW, "run_1", verify=True)
    assert (first.rows_read, first.final_count) == (5, 5)
    assert marks.current("orders") == Mark("2025-01-15 00:00:00", "5")
    assert [r.order_id for r in first.latest.collect()] == [5, 4, 3, 2, 1]

    changed = source.where("order_id > 2").unionByName(
        data.orders(
            spark,
            data.order(1, "2025-02-01", "1.50"),
            data.order(2, "2025-01-12"),
            data.order(6, "2025-02-01"),
        )
    )
    second = load_increment(t, changed, NOW, "run_2", verify=True)
    assert (second.rows_read, second.final_count) == (2, 6)
    assert data.values(t.read(), "order_id", "price", "etl_job_run_id") == [
        (1, Decimal("1.50"), "run_2"),
        *[(i, Decimal("10.00"), "run_1") for i in range(2, 6)],
        (6, Decimal("10.00"), "run_2"),
    ]
    assert data.values(marks.list(), "table_name", "updated_at", "last_key") == [
        ("orders", "2025-02-01 00:00:00", "6")
    ]
    listed = {r.value for r in spark.read.text(second.manifest).collect()}
    assert listed == {r.path for r in list_files(spark, t.location, "*.parquet").collect()}


def test_empty_increment_writes_nothing(spark, lake):
    t = lake.table("orders", "order_id")
    assert load_increment(t, data.orders(spark).limit(0), NOW, "run_0").rows_read == 0
    assert not t.exists() and Watermarks(lake).current("orders") is None
    source = data.orders(spark, data.order(1, "2025-01-15"))
    load_increment(t, source, NOW, "run_1")
    before = list_files(spark, t.location).collect()
    marks = Watermarks(lake).list().collect()
    assert load_increment(t, source, NOW, "run_2").rows_read == 0
    assert list_files(spark, t.location).collect() == before
    assert Watermarks(lake).list().collect() == marks


def test_failed_write_leaves_the_mark(spark, lake, monkeypatch):
    t, marks = lake.table("orders", "order_id"), Watermarks(lake)
    source = data.orders(spark, data.order(1, "2025-01-15"))
    load_increment(t, source, NOW, "run_1")
    mark = marks.current("orders")
    more = source.unionByName(data.orders(spark, data.order(2, "2025-01-16")))

    def fail(self, rows, summary):
        raise RuntimeError("merge failed")

    with monkeypatch.context() as patch:
        patch.setattr(LakeTable, "_merge", fail)
        with pytest.raises(RuntimeError):
            load_increment(t, more, NOW, "run_2")
    assert marks.current("orders") == mark
    assert load_increment(t, more, NOW, "run_3").rows_read == 1


def test_reset_reads_everything_again(spark, lake):
    marks = Watermarks(lake)
    marks.reset("orders")
    assert marks.list().collect() == []
    tables = [lake.table("orders", "order_id"), lake.table("refunds", "order_id")]
    source = data.orders(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16"))
    for t in tables:
        load_increment(t, source, NOW, "run_1")
    marks.reset("orders")
    assert marks.current("orders") is None
    assert data.values(marks.list(), "table_name") == [("refunds",)]
    assert load_increment(tables[0], source, NOW, "run_2").rows_read == 2
    assert tables[0].read().count() == 2
    marks.reset_all()
    assert marks.list().collect() == []


def test_table_without_updated_at(spark, lake):
    t = lake.table("codes", "id")
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, code STRING")
    load_increment(t, source, NOW, "run_1")
    run = load_increment(t, source.union(spark.createDataFrame([(3, "c")], source.schema)), NOW, "run_2", verify=True)
    assert (run.rows_read, run.final_count) == (1, 3)
    assert data.values(t.read(), "id", "year", "month", "day") == [(i, 2025, 8, 1) for i in (1, 2, 3)]
    assert Watermarks(lake).current("codes") == Mark(None, "3")


def test_change_log_in_the_first_load(spark, lake):
    t = lake.table("orders", "order_id")
    source = data.orders(spark, data.order(1, "2025-01-15", "1.00"), data.order(1, "2025-01-16", "2.00"))
    run = load_increment(t, source, NOW, "run_1", verify=True)
    assert run.final_count == 1
    assert data.values(t.read(), "order_id", "price") == [(1, Decimal("2.00"))]


def test_compaction_in_a_load(spark, lake):
    t = lake.table("orders", "order_id")
    source = data.orders(spark, *[data.order(i, f"2025-01-15T00:{i:02d}") for i in range(4)])
    for i in range(4):
        load_increment(t, source.where(f"order_id <= {i}"), NOW, f"run_{i}", max_files=2)
    assert t.read().count() == 4
    assert list_files(spark, t.location, "*.parquet").count() == 2


def test_all_tables_and_their_gate(spark, lake):
    orders, people = lake.table("orders", "order_id"), lake.table("customers", "customer_id")
    sold = data.orders(spark, data.order(1, "2025-01-15"))
    known = data.customers(spark, (1, "ann", "2025-01-01", "2025-01-01"))
    bad = sold.withColumn("price", F.raise_error("bad row").cast("decimal(10,2)"))
    failed = load_all([(orders, bad), (people, known)], NOW, "run_1")
    assert set(failed.errors) == {"orders"} and failed.profile is None
    assert failed.runs["customers"].rows_read == 1
    done = load_all([(orders, sold), (people, known)], NOW, "run_2")
    assert not done.errors and done.runs["customers"].rows_read == 0
    counts = done.profile.select("table_name", "row_count").distinct()
    assert data.values(counts, "table_name", "row_count") == [("customers", 1), ("orders", 1)]


def test_landed_files_are_read_once(spark, lake, tmp_path):
    t, landed, state = lake.table("orders", "order_id"), str(tmp_path / "in"), str(tmp_path / "state")
    data.orders(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-15")).write.parquet(landed)
    load_landed_files(t, landed, data.ORDER, state, NOW)
    assert t.read().count() == 2
    data.orders(spark, data.order(2, "2025-01-16", "7.00")).write.mode("append").parquet(landed)
    load_landed_files(t, landed, data.ORDER, state, NOW)
    load_landed_files(t, landed, data.ORDER, state, NOW)
    assert data.values(t.read(), "order_id", "price", "etl_job_run_id") == [
        (1, Decimal("10.00"), "orders_0"),
        (2, Decimal("7.00"), "orders_1"),
    ]


def test_all_tables_load_at_once(spark, lake, monkeypatch):
    """Each load waits for the other one, in a session and pool of its own; settings stay apart."""
    orders, people = lake.table("orders", "order_id"), lake.table("customers", "customer_id")
    sold = data.orders(spark, data.order(1, "2025-01-15"))
    known = data.customers(spark, (1, "ann", "2025-01-01", "2025-01-01"))
    meet, seen = threading.Barrier(2, timeout=60), {}

    def load(table, source, *args, **kwargs):
        meet.wait()
        pool = table.spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        seen[table.short_name] = table.spark, source.sparkSession, pool
        table.spark.conf.set("spark.sql.shuffle.partitions", str(len(seen)))
        return load_increment(table, source, *args, **kwargs)

    monkeypatch.setattr(incremental, "load_increment", load)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    done = load_all([(orders, sold), (people, known)], NOW, "run_1")
    assert not done.errors and {n: r.rows_read for n, r in done.runs.items()} == {"orders": 1, "customers": 1}
    assert {n: pool for n, (_, _, pool) in seen.items()} == {"orders": "load_orders", "customers": "load_customers"}
    assert len({id(s) for s, _, _ in seen.values()} | {id(spark)}) == 3
    assert all(s._jsparkSession.equals(t._jsparkSession) for s, t, _ in seen.values())
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert orders.read().count() == people.read().count() == 1
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("moved_")]
