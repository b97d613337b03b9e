import random
from decimal import Decimal

import data
import pytest
from pyspark.sql import functions as F
from tidemark.functions.audit import prepared
from tidemark.operators.increments import summarize
from tidemark.operators.lake import LakeTable
from tidemark.session import session_conf
from tidemark.sources.files import list_files, list_partition_files


def rows(spark, *orders):
    return prepared(data.orders(spark, *orders), "2025-08-01 00:00:00", "run")


def table(lake) -> LakeTable:
    return lake.table("orders", "order_id")


def stored(t: LakeTable) -> list[tuple]:
    return data.values(t.read(), "order_id", "price", "year", "month", "day")


def on_disk(t: LakeTable) -> list[tuple]:
    """Rows by path, so that stray files would show."""
    return data.values(t.spark.read.parquet(t.location), "order_id", "price", "year", "month", "day")


def files(t: LakeTable) -> list[str]:
    return sorted(r.path for r in list_files(t.spark, t.location, "*.parquet").collect())


def staged(lake) -> list:
    return lake.spark.sql(f"SHOW TABLES IN {lake.staging}").collect()


def test_create_partitions_by_day(spark, lake):
    t = table(lake)
    assert not t.exists()
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-07-24")))
    assert t.exists()
    names = [r.partition for r in t.partitions().orderBy("number").collect()]
    assert names == ["year=2025/month=1/day=15", "year=2025/month=7/day=24"]
    assert stored(t) == on_disk(t)


def test_first_load_is_repeated_after_a_failure(spark, lake):
    t = table(lake)
    good = rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16"))
    with pytest.raises(Exception, match="bad row"):
        t.create(good.withColumn("price", F.raise_error("bad row").cast("decimal(10,2)")))
    assert t.exists() and t.is_empty() and t.latest().count() == 0
    assert t.upsert(good.withColumn("channel", F.lit("web"))).rows == 2
    assert data.values(t.read(), "order_id", "channel") == [(1, "web"), (2, "web")]
    with pytest.raises(ValueError):
        t.create(good)


def test_create_reduces_repeated_keys(spark, lake):
    t = table(lake)
    t.create(
        rows(
            spark,
            data.order(1, "2025-01-15", "1.00"),
            data.order(1, "2025-01-16", "2.00"),
            data.order(2, "2025-01-15", "3.00"),
        )
    )
    want = [(1, Decimal("2.00"), 2025, 1, 16), (2, Decimal("3.00"), 2025, 1, 15)]
    assert stored(t) == on_disk(t) == want


def test_update_moves_between_partitions(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-15")))
    t.upsert(rows(spark, data.order(1, "2025-07-24", "11.00")))
    want = [(1, Decimal("11.00"), 2025, 7, 24), (2, Decimal("10.00"), 2025, 1, 15)]
    assert stored(t) == on_disk(t) == want


def test_emptied_partition_is_dropped(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16")))
    t.upsert(rows(spark, data.order(1, "2025-01-16", "11.00")))
    want = [(1, Decimal("11.00"), 2025, 1, 16), (2, Decimal("10.00"), 2025, 1, 16)]
    assert stored(t) == on_disk(t) == want
    assert [r.number for r in t.partitions().collect()] == [20250116]
    assert staged(lake) == []


def test_replayed_batch_changes_nothing(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16")))
    batch = rows(
        spark,
        data.order(1, "2025-01-17", "5.00"),
        data.order(3, "2025-01-16", "6.00"),
        data.order(4, "2025-01-18", "7.00"),
    )
    t.upsert(batch)
    once = stored(t)
    t.upsert(batch)
    assert stored(t) == on_disk(t) == once and len(once) == 4


def test_new_rows_do_not_rewrite_files(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16")))
    before = files(t)
    t.upsert(rows(spark, data.order(3, "2025-01-16"), data.order(4, "2025-01-17")))
    assert set(before) < set(files(t)) and t.read().count() == 4


def test_update_rewrites_only_its_partitions(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16")))
    before = files(t)
    t.upsert(rows(spark, data.order(2, "2025-01-17")))
    kept = [f for f in before if "day=15" in f]
    assert set(files(t)) & set(before) == set(kept)


def test_rows_without_a_date(spark, lake):
    t = table(lake)
    undated = rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-15"))
    undated = undated.withColumns(
        {c: F.when(F.col("order_id") == 1, F.col(c)) for c in ("updated_at", "year", "month", "day")}
    )
    t.create(undated)
    t.upsert(undated)
    assert stored(t) == [(1, Decimal("10.00"), 2025, 1, 15), (2, Decimal("10.00"), None, None, None)]
    t.upsert(rows(spark, data.order(2, "2025-01-16")))
    assert stored(t) == on_disk(t)
    assert [r.number for r in t.partitions().orderBy("number").collect()] == [20250115, 20250116]


def test_new_column_in_the_batch(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-15")))
    t.upsert(rows(spark, data.order(2, "2025-01-15")).withColumn("channel", F.lit("web")))
    t.upsert(rows(spark, data.order(3, "2025-01-15")))
    assert data.values(t.read(), "order_id", "channel") == [(1, None), (2, "web"), (3, None)]


def test_only_newer_rows(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15")))
    t.upsert(rows(spark, data.order(1, "2025-01-14", "9.00"), data.order(2, "2025-01-14")), True)
    assert data.values(t.read(), "order_id", "price") == [
        (1, Decimal("10.00")),
        (2, Decimal("10.00")),
    ]


def test_full_refresh(spark, lake):
    t = table(lake)
    t.refresh(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16")))
    t.refresh(rows(spark, data.order(3, "2025-01-16")))
    assert stored(t) == on_disk(t) == [(3, Decimal("10.00"), 2025, 1, 16)]


def test_latest_reads_the_newest_partitions(spark, lake):
    t = table(lake)
    t.create(rows(spark, *[data.order(i, f"2025-01-{i:02d}") for i in range(1, 10)]))
    assert [r.order_id for r in t.latest(3).collect()] == [9, 8, 7]
    assert "PartitionFilters: [coalesce" in plan(t.latest(3))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_eleven_files_are_compacted_and_ten_are_not(spark, lake):
    t = table(lake)
    t.create(rows(spark, *[data.order(i, f"2025-01-{10 + i}") for i in range(10)]))
    assert len(files(t)) == 10
    assert t.compact() == 0 and len(files(t)) == 10
    t.upsert(rows(spark, data.order(10, "2025-01-15")))
    before, held = stored(t), files(t)
    assert len(held) == 11 and t.compact() == 1
    assert len(files(t)) == 10 and stored(t) == on_disk(t) == before
    assert len(set(held) & set(files(t))) == 9
    assert t.compact(max_files=1) == 0


def test_manifest_lists_live_files_only(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16")))
    first = t.write_manifest()
    t.upsert(rows(spark, data.order(1, "2025-01-16")))
    assert t.write_manifest() == first
    listed = sorted(r.value for r in spark.read.text(first).collect())
    assert listed == files(t) and all("day=16" in f for f in listed)


def test_work_after_a_batch_follows_the_batch(spark, lake, monkeypatch):
    """A table of 60 days and a batch for one of them: one folder is listed."""
    t = table(lake)
    days = [f"2025-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 21)]
    t.create(rows(spark, *[data.order(i, day) for i, day in enumerate(days)]))
    folder = t.write_manifest()
    seen = []
    monkeypatch.setattr(
        "tidemark.operators.lake.list_partition_files",
        lambda spark, folder, inside=None: seen.append(inside) or list_partition_files(spark, folder, inside),
    )
    done = t.upsert(rows(spark, data.order(100, "2025-02-05")))
    assert done.touched == {20250205}
    t.compact(max_files=1, within=done.touched)
    t.write_manifest(done.touched)
    assert seen == [["year=2025/month=2/day=5"]] * 2
    assert sorted(r.value for r in spark.read.text(folder).collect()) == files(t)


def test_interrupted_swap_is_finished_by_the_next_run(spark, lake, monkeypatch):
    t = table(lake)
    t.create(rows(spark, *[data.order(i, f"2025-01-{i}") for i in (11, 12, 13)]))
    batch = rows(spark, data.order(11, "2025-01-12", "1.00"), data.order(14, "2025-01-14"))
    publish = LakeTable._publish

    def die(self, run):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(LakeTable, "_publish", die)
    with pytest.raises(RuntimeError):
        t.upsert(batch)
    monkeypatch.setattr(LakeTable, "_publish", publish)
    assert len(staged(lake)) == 4  # rows, plan, batch and the sign to merge it again
    t.finish_interrupted()
    once = stored(t)
    assert (11, Decimal("1.00"), 2025, 1, 12) in once and len(once) == 4
    t.upsert(batch)
    assert stored(t) == on_disk(t) == once and staged(lake) == []


def test_a_merge_that_died_half_way_leaves_no_key_twice(spark, lake, monkeypatch):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-11"), data.order(2, "2025-01-12")))
    publish = LakeTable._publish

    def die(self, run):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(LakeTable, "_publish", die)
    with pytest.raises(RuntimeError):  # key 1 moves to February
        t.upsert(rows(spark, data.order(1, "2025-02-01", "1.00"), data.order(3, "2025-01-12")))
    monkeypatch.setattr(LakeTable, "_publish", publish)
    t.upsert(rows(spark, data.order(9, "2025-03-01")))
    assert data.values(t.read(), "order_id", "month", "day") == [(1, 2, 1), (2, 1, 12), (3, 1, 12), (9, 3, 1)]
    assert stored(t) == on_disk(t) and staged(lake) == []


def test_failed_staging_leaves_the_table_alone(spark, lake):
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15")))
    before = stored(t)
    broken = rows(spark, data.order(1, "2025-01-16")).withColumn(
        "price", F.raise_error("bad row").cast("decimal(10,2)")
    )
    with pytest.raises(Exception, match="bad row"):
        t.upsert(broken)
    assert stored(t) == on_disk(t) == before


def test_files_left_by_a_dead_append_do_not_double_rows(spark, lake):
    """A new partition's folder may hold files that never got into the catalog."""
    t = table(lake)
    t.create(rows(spark, data.order(1, "2025-01-15")))
    batch = rows(spark, data.order(2, "2025-01-16"))
    batch.drop("year", "month", "day").write.parquet(f"{t.location}/year=2025/month=1/day=16")
    manifest = spark.read.text(t.write_manifest())
    assert manifest.count() == 1
    t.upsert(batch)
    assert stored(t) == on_disk(t) and t.read().count() == 2


def test_many_keys_are_not_broadcast(spark, lake, monkeypatch):
    t = table(lake)
    batch = data.orders(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-15"))
    summary = summarize(batch, "order_id")
    joined = spark.range(9).join(t._keys(batch, summary), F.col("id") == F.col("order_id"))
    assert "BroadcastHashJoin" in plan(joined)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        monkeypatch.setattr("tidemark.operators.lake.BROADCAST_KEYS", 1)
        keys = t._keys(batch, summary)
        assert "SortMergeJoin" in plan(spark.range(9).join(keys, F.col("id") == F.col("order_id")))
        t.create(rows(spark, data.order(1, "2025-01-14"), data.order(3, "2025-01-14")))
        t.upsert(prepared(batch, "2025-08-01", "run"))
    assert data.values(t.read(), "order_id", "day") == [(1, 15), (2, 15), (3, 14)]


@pytest.mark.parametrize("seed", [11])
def test_any_batches_leave_the_latest_rows(spark, lake, seed):
    """Random batches, some replayed, with compactions between: latest row per key, on disk too."""
    draw, t, want, hour = random.Random(seed), table(lake), {}, 0
    for number in range(4):
        batch = []
        for _ in range(draw.randint(1, 8)):
            hour += draw.randint(0, 30)
            stamp = f"2025-01-{1 + hour // 24:02d}T{hour % 24:02d}:{len(batch):02d}"
            batch.append(data.order(draw.randint(1, 10), stamp, f"{draw.randint(1, 99)}.00"))
        for row in batch:
            want[row[0]] = row
        for _ in range(draw.randint(1, 2)):
            t.upsert(rows(spark, *batch))
        if number % 2:
            t.compact(max_files=1)
    expected = sorted(
        (
            (r[0], Decimal(r[4]), *(int(x) for x in r[5][:10].split("-")))
            for r in want.values()
        ),
        key=repr,
    )
    assert stored(t) == on_disk(t) == expected


def test_first_load_of_a_log_with_one_frequent_key(spark, lake):
    """A third of a change log is versions of one key; one row of it remains."""
    log = spark.range(30_000).selectExpr(
        "CAST(IF(id % 3 = 0, 0, id) AS INT) AS order_id",
        "CAST(id AS STRING) AS product_name",
        "TIMESTAMP_NTZ '2025-01-01' + make_dt_interval(0, 0, 0, id) AS updated_at",
    )
    t = table(lake)
    summary = t.create(prepared(log.repartition(8), "2025-08-01", "run"))
    assert summary.repeated and summary.rows == 30_000
    assert t.count() == t.read().select("order_id").distinct().count() == 20_001
    assert t.read().where("order_id = 0").first().product_name == "29997"


def test_hot_day_is_spread_over_files(spark, lake, monkeypatch):
    """A day with most of the rows is written by several tasks."""
    monkeypatch.setattr("tidemark.operators.lake.SHUFFLED_BYTES_PER_FILE", 200_000)
    hot = spark.range(200_000).selectExpr(
        "CAST(id AS INT) AS order_id",
        "uuid() AS product_name",
        "CASE WHEN id % 3 = 0 THEN TIMESTAMP_NTZ '2025-01-01' "
        "ELSE TIMESTAMP_NTZ '2025-01-01' + make_dt_interval(id % 50) END AS updated_at",
    )
    t = table(lake)
    t.create(prepared(hot.repartition(8), "2025-08-01", "run"))
    assert t.read().count() == 200_000
    per_day = [f.split("day=")[1].split("/")[0] for f in files(t) if "month=1/" in f]
    assert per_day.count("1") > 2
