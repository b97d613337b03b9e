"""The k-th row of an increment, found by counting."""

import random
from datetime import datetime, timedelta

import pytest
from tidemark.operators import increments
from tidemark.operators.increments import Mark, kth_row, micro_batch


def source(spark, kind, key, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(600):
        stamp = None if i % 11 == 0 else datetime(2025, 3, 30) + timedelta(minutes=draw.randrange(0, 400) ** 2, microseconds=draw.choice([0, 1]))
        if i % 3 == 0 and stamp:
            stamp = datetime(2025, 4, 1, 12)  # a third of all rows
        rows.append((stamp, i * 7 % 600 - 300))
    frame = spark.createDataFrame(rows, "at timestamp_ntz, id int").repartition(4)
    return frame.selectExpr(f"CAST(at AS {kind}) AS updated_at", f"CAST(id AS {key}) AS id")


def ordered(frame, kind):
    rows = [(r["updated_at"], r["id"]) for r in frame.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.fixture
def few_ranges(monkeypatch):
    monkeypatch.setattr(increments, "RANGES", 5)
    monkeypatch.setattr(increments, "SORTED_ROWS", 10)


@pytest.mark.parametrize("kind, key", [("timestamp_ntz", "int"), ("timestamp", "string"), ("date", "bigint"), ("string", "int")])
def test_batches_follow_the_order(spark, few_ranges, kind, key):
    frame = source(spark, kind, key).cache()
    want = ordered(frame, kind)
    for size in (55, 56, 301, 600):
        got = ordered(micro_batch(frame, None, "id", size), kind)
        assert got == want[:size], size


def test_steps_read_every_row_once(spark, few_ranges):
    frame = source(spark, "timestamp_ntz", "int", 2).cache()
    want, got, mark = ordered(frame, ""), [], None
    while rows := ordered(micro_batch(frame, mark, "id", 130), ""):
        got += rows
        mark = increments.high_mark(micro_batch(frame, mark, "id", 130), "id").after(mark)
    assert got == want


def test_rows_that_share_stamp_and_key_come_together(spark, few_ranges):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2025-01-01' AS updated_at, CAST(id DIV 50 AS INT) AS id FROM range(200)")
    assert micro_batch(frame, None, "id", 60).count() == 100
    assert micro_batch(frame, Mark("2025-01-01 00:00:00", 1), "id", 60).count() == 100
    assert kth_row(frame, "id", 200) is None and micro_batch(frame.where("false"), None, "id", 3).count() == 0


def test_only_a_few_rows_are_sorted(spark, monkeypatch):
    """A million rows of one stamp: what is left to the sort is bounded."""
    monkeypatch.setattr(increments, "SORTED_ROWS", 1000)
    seen = []
    crossing = increments._crossing
    monkeypatch.setattr(increments, "_crossing", lambda *a: seen.append(crossing(*a)) or seen[-1])
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2025-01-01' AS updated_at, id * 3 AS id FROM range(1000000)")
    assert kth_row(frame, "id", 777_777)["key"] == 777_776 * 3
    assert seen[0][1] == 1_000_000 and seen[1][1] <= 1000
