import random

import pytest
from pyspark.sql import functions as F
from test_lake import data, files, on_disk, rows, staged, stored, table
from tidemark.operators import lake as lakes
from tidemark.operators.packing import crowded, first_fit, packed_bins
from tidemark.sources.files import list_files


def test_first_fit_is_the_plain_one():
    draw = random.Random(5)
    for n in (0, 1, 2, 7, 64, 200):
        lengths = sorted((draw.randint(1, 50) for _ in range(n)), reverse=True)
        room, want = [], []
        for length in lengths:
            at = next((i for i, r in enumerate(room) if r >= length), len(room))
            if at == len(room):
                room.append(100)
            room[at] -= length
            want.append(at)
        assert first_fit(lengths, 100) == want


def test_only_small_files_of_crowded_partitions_are_packed(spark):
    listed = [("f:/t/d=1/a", 90, 1), ("f:/t/d=1/b", 5, 1), ("f:/t/d=1/c", 5, 1), ("f:/t/d=2/a", 45, 2), ("f:/t/d=2/b", 45, 2), ("f:/t/d=3/a", 1, 3)]
    small = crowded(spark.createDataFrame(listed, "path STRING, length BIGINT, number INT"), 100)
    assert sorted(r.path for r in small.collect()) == ["f:/t/d=1/b", "f:/t/d=1/c"]
    assert sorted(map(tuple, packed_bins(small, 100).collect())) == [(1, "f:/t/d=1", "b", 0), (1, "f:/t/d=1", "c", 0)]
    assert packed_bins(small.limit(0), 100).isEmpty()


def crowd(spark, lake):
    """A day with a large file and eight small ones, and a day of one file."""
    t = table(lake)
    t.create(rows(spark, *[data.order(i, f"2025-01-15T00:{i % 60:02d}:01", str(i * i % 99991)) for i in range(4000)], data.order(5000, "2025-01-16")))
    for i in range(8):
        t._insert(rows(spark, data.order(6000 + i, "2025-01-15", "3.00")), False, look=False)
    return t


def sizes(t):
    return {r.path: r.length for r in list_files(t.spark, t.location, "*.parquet").collect()}


def test_large_files_are_left_where_they_are(spark, lake):
    t = crowd(spark, lake)
    before, held = stored(t), sizes(t)
    large = max(held, key=held.get)
    assert t.compact(max_files=1, target_bytes=2 * held[large]) == 1
    left = sizes(t)
    assert left[large] == held[large] and len(left) == len(held) - 7
    assert stored(t) == on_disk(t) == before
    assert len([p for p in left if "/packed-" in p]) == 1 and not staged(lake)


@pytest.mark.parametrize("step", ["move_files", "remove_file"])
def test_a_packing_that_died_is_finished(spark, lake, monkeypatch, step):
    t = crowd(spark, lake)
    before = stored(t)
    calls = []

    def die(*args):
        calls.append(args)
        raise RuntimeError("died")

    with monkeypatch.context() as patched:
        patched.setattr(lakes, step, die)
        with pytest.raises(RuntimeError, match="died"):
            t.compact(max_files=1)
    assert calls and staged(lake)
    t.upsert(rows(spark, data.order(6001, "2025-01-15", "9.00"), data.order(6002, "2025-01-17", "9.00")))
    want = [r for r in before if r[0] not in (6001, 6002)] + [r for r in stored(t) if r[0] in (6001, 6002)]
    assert stored(t) == on_disk(t) == sorted(want, key=repr) and t.count() == len(before)
    assert {r[0]: str(r[1]) for r in stored(t)}[6002] == "9.00" and not staged(lake)


def test_a_packing_that_died_while_writing_changes_nothing(spark, lake, monkeypatch):
    t = crowd(spark, lake)
    before, held = stored(t), files(t)
    stage = t._stage

    def die(kind, df, run=None):
        if kind == "packed":
            raise RuntimeError("died")
        return stage(kind, df, run)

    with monkeypatch.context() as patched:
        patched.setattr(t, "_stage", die)
        with pytest.raises(RuntimeError, match="died"):
            t.compact(max_files=1)
    assert stored(t) == before and files(t) == held
    assert t.finish_interrupted() and not t.finish_interrupted()
    assert stored(t) == on_disk(t) == before and files(t) == held and not staged(lake)


def test_packing_keeps_rows_without_a_day_and_new_columns(spark, lake):
    t = table(lake)
    bare = [rows(spark, data.order(i, "2025-01-15")).withColumns({c: F.lit(None).cast("int") for c in ("year", "month", "day")}) for i in range(3)]
    t.create(bare[0])
    t._insert(bare[1], False, look=False)
    t.upsert(bare[2].withColumn("channel", F.lit("web")))
    before = data.values(t.read(), "order_id", "channel", "year")
    assert len(files(t)) == 3 and t.compact(max_files=1) == 1 and len(files(t)) == 1
    assert data.values(t.read(), "order_id", "channel", "year") == before
