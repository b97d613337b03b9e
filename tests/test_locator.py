"""The locator of keys that merges keep, and summaries told by the write."""

import data
import pytest
from pyspark.sql import functions as F
from tidemark.functions.audit import prepared
from tidemark.operators import lake as lake_module
from tidemark.operators import locator as locator_module
from tidemark.operators.increments import observed, summarize
from tidemark.operators.lake import LakeTable
from tidemark.session import session_conf


def rows(spark, *orders):
    return prepared(data.orders(spark, *orders), "2025-08-01 00:00:00", "run")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(t):
    return data.values(t.read(), "order_id", "month", "day")


def held(t, *keys):
    keys = t.spark.createDataFrame([(k,) for k in keys], "order_id INT")
    return {r["number"] for r in t.locator.holding(keys, len(keys.collect()), -10**6, 10**6, "none").collect()}


@pytest.mark.parametrize("points", [0, 1000])
def test_locator_follows_every_merge(spark, lake, monkeypatch, points):
    monkeypatch.setattr(locator_module, "POINT_KEYS", points)
    monkeypatch.setattr(locator_module, "GENERATIONS", 3)
    t = lake.table("orders", "order_id")
    t.create(rows(spark, *[data.order(i, f"2025-01-1{i}") for i in range(6)]), unique=True)
    assert not t.locator.exists()
    scans = []
    monkeypatch.setattr(t.locator, "build", lambda e, n, f=t.locator.build: scans.append(n) or f(e, n))
    moves = [(1, "2025-02-01"), (1, "2025-02-02"), (2, "2025-02-02"), (9, "2025-03-01"), (1, "2025-01-11")]
    for key, day in moves:
        t.upsert(rows(spark, data.order(key, day)), unique=True)
    # Built from the table once, and once from its own entries.
    assert scans[0] == 6 and len(scans) == 2
    assert stored(t) == [(0, 1, 10), (1, 1, 11), (2, 2, 2), (3, 1, 13), (4, 1, 14), (5, 1, 15), (9, 3, 1)]
    assert held(t, 1) == {20250111} and held(t, 2, 9) == {20250202, 20250301} and held(t, 77) == set()
    t.refresh(rows(spark, data.order(7, "2025-01-10")))
    assert not t.locator.exists()
    t.upsert(rows(spark, data.order(7, "2025-01-12")))
    assert stored(t) == [(7, 1, 12)] and held(t, 7) == {20250112}


def test_locator_side_does_not_move(spark, lake, monkeypatch):
    monkeypatch.setattr(locator_module, "POINT_KEYS", 0)
    t = lake.table("orders", "order_id")
    t.create(rows(spark, *[data.order(i, f"2025-01-1{i}") for i in range(6)]))
    t.upsert(rows(spark, data.order(1, "2025-01-12")))
    keys = spark.createDataFrame([(1,), (2,)], "order_id INT")
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        text = plan(t.locator.holding(keys, 2, 0, 9, "none"))
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    # Only the batch's keys and the numbers found are dealt out.
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert all("number" in line or text.split(line)[1].lstrip(" :+-|").count("locator_orders") == 0 or "Scan ExistingRDD" in text.split(line)[1].splitlines()[2] for line in moved)
    for line in moved:
        below = text.split(line)[1].splitlines()[1:4]
        assert "number" in line or not any("locator_orders" in x for x in below)


def test_a_small_batch_opens_no_file_of_the_table(spark, lake, monkeypatch):
    t = lake.table("orders", "order_id")
    t.create(rows(spark, *[data.order(i, f"2025-01-1{i}") for i in range(6)]))
    t.upsert(rows(spark, data.order(1, "2025-01-12")))
    read = []
    monkeypatch.setattr(LakeTable, "read", lambda self, f=LakeTable.read: read.append(1) or f(self))
    batch = rows(spark, data.order(3, "2025-01-13"), data.order(50, "2025-01-13"))
    summary = lake_module.replace(summarize(batch, "order_id"), staged="x")
    assert t._partitions_holding(batch, summary) == {20250113} and read == []


def test_a_run_that_died_after_its_entries_is_repeated(spark, lake, monkeypatch):
    """The entries speak of partitions that the rows never reached; the old place still counts."""
    t = lake.table("orders", "order_id")
    t.create(rows(spark, data.order(1, "2025-01-11"), data.order(2, "2025-01-12")))
    insert = LakeTable._insert

    def die(self, *args, **kwargs):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(LakeTable, "_insert", die)
    with pytest.raises(RuntimeError):
        t.upsert(rows(spark, data.order(1, "2025-05-01"), data.order(3, "2025-05-02")))
    monkeypatch.setattr(LakeTable, "_insert", insert)
    t.upsert(rows(spark, data.order(1, "2025-06-01")))
    assert stored(t) == [(1, 6, 1), (2, 1, 12), (3, 5, 2)]


def test_a_lost_locator_is_built_again(spark, lake):
    t = lake.table("orders", "order_id")
    t.create(rows(spark, data.order(1, "2025-01-11"), data.order(2, "2025-01-12")))
    t.upsert(rows(spark, data.order(1, "2025-01-13")))
    t.locator.drop()
    t.upsert(rows(spark, data.order(1, "2025-01-14")))
    assert stored(t) == [(1, 1, 14), (2, 1, 12)]


def test_the_write_tells_the_summary(spark, tmp_path):
    frame = data.orders(spark, data.order(5, "2025-01-15"), data.order(2, "2025-07-24"), data.order(9, "2025-07-24"))
    bare = frame.withColumn("updated_at", F.when(F.col("order_id") != 5, F.col("updated_at")))
    for name, df in (("a", frame), ("b", bare), ("c", frame.drop("updated_at")), ("d", frame.where("order_id < 0"))):
        watched, look = observed(df, "order_id")
        watched.write.parquet(str(tmp_path / name))
        assert look() in (summarize(df, "order_id", unique=True), None)


def test_a_load_of_unique_keys_reads_no_batch_twice(spark, lake, monkeypatch):
    seen = []
    monkeypatch.setattr(lake_module, "summarize", lambda *a, **k: seen.append(a) or summarize(*a, **k))
    t = lake.table("orders", "order_id")
    first = t.upsert(rows(spark, data.order(1, "2025-01-11"), data.order(2, "2025-01-12")), unique=True)
    second = t.upsert(rows(spark, data.order(2, "2025-01-13")), unique=True)
    assert (first.rows, second.rows, second.mark.key, seen) == (2, 1, 2, [])


RETRIED = """
import sys
sys.path[:0] = {paths!r}
import os, tempfile
from pyspark.sql import SparkSession, functions as F
from pyspark import TaskContext
from tidemark.operators.increments import observed
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()

@F.udf("int")
def flaky(x):
    if TaskContext.get().attemptNumber() == 0 and x % 40 == 39:
        raise RuntimeError("lost")
    return x

frame = spark.range(0, 200, 1, 5).select(flaky(F.col("id").cast("int")).alias("order_id"), F.lit("2025-01-01").cast("timestamp_ntz").alias("updated_at"))
watched, look = observed(frame, "order_id")
watched.write.parquet(tempfile.mkdtemp() + "/x")
found = look()
print("FOUND", found.rows, found.low_key, found.high_key, found.mark.key)
spark.stop()
"""


def test_tasks_that_are_tried_again_count_once(tmp_path):
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRIED.format(paths=[here])], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert "FOUND 200 0 199 199" in done.stdout, done.stderr[-2000:]
