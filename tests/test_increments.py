import data
from pyspark.sql import functions as F
from tidemark.operators import increments
from tidemark.operators.increments import Mark
from tidemark.operators.ranking import latest_rows, sample_rows


def ids(df, key="order_id"):
    return sorted(r[key] for r in df.select(key).collect())


def test_no_mark_reads_everything(spark):
    sold = data.orders(spark, data.order(1, "2025-01-01"), data.order(2, "2025-01-02"))
    assert ids(increments.after_mark(sold, None, "order_id")) == [1, 2]


def test_update_to_a_low_key_is_read(spark):
    sold = data.orders(spark, data.order(1, "2025-01-03"), data.order(9, "2025-01-02"))
    mark = Mark("2025-01-02 00:00:00", "9")
    assert ids(increments.after_mark(sold, mark, "order_id")) == [1]


def test_mark_keeps_microseconds(spark):
    sold = data.orders(spark, data.order(1, "2025-01-01T00:00:00.000001"))
    mark = increments.high_mark(sold, "order_id")
    assert mark == Mark("2025-01-01 00:00:00.000001", 1)
    assert ids(increments.after_mark(sold, mark, "order_id")) == []


def test_micro_batches_lose_no_tie(spark):
    sold = data.orders(spark, *[data.order(i, "2025-01-01") for i in (3, 1, 2, 5, 4)])
    mark, batches = None, []
    while rows := ids(batch := increments.micro_batch(sold, mark, "order_id", 2)):
        batches.append(rows)
        mark = increments.high_mark(batch, "order_id")
    assert batches == [[1, 2], [3, 4], [5]]


def test_table_without_updated_at_is_read_by_key(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    mark = increments.high_mark(df.where("id < 3"), "id")
    assert mark == Mark(None, 2)
    assert ids(increments.after_mark(df, mark, "id"), "id") == [3]


def test_rows_that_get_their_first_stamp_are_read(spark):
    sold = data.orders(spark, data.order(1, "2025-01-01"), data.order(2, "2025-01-01"))
    bare = sold.selectExpr("order_id", "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")
    mark = increments.high_mark(bare, "order_id")
    assert mark == Mark(None, 2, 2)
    later = bare.where("order_id = 2").unionByName(sold.where("order_id = 1").select(*bare.columns))
    assert ids(increments.after_mark(later, mark, "order_id")) == [1]


def test_summary_tells_repeats_and_range(spark):
    sold = data.orders(
        spark, data.order(4, "2025-01-01"), data.order(4, "2025-01-03"), data.order(7, "2025-01-02")
    )
    found = increments.summarize(sold, "order_id")
    assert (found.rows, found.low_key, found.high_key, found.repeated) == (3, 4, 7, True)
    assert found.mark == Mark("2025-01-03 00:00:00", 4)
    assert increments.summarize(sold.limit(0), "order_id") == increments.Summary.empty()


def test_order_filter_takes_recent_dates_or_later_updates(spark):
    sold = spark.createDataFrame(
        [
            (1, data.at("2025-01-20").date(), data.at("2025-01-01")),
            (2, data.at("2025-01-01").date(), data.at("2025-01-11")),
            (3, data.at("2025-01-12").date(), data.at("2025-01-01")),
            (4, data.at("2025-01-13").date(), data.at("2025-01-10")),
        ],
        "order_id INT, order_date DATE, updated_at TIMESTAMP_NTZ",
    )
    assert ids(increments.changed_orders(sold, "2025-01-10 00:00:00", "2025-01-20")) == [1, 2, 4]


def test_feed_tags_inserts_and_updates(spark):
    people = data.customers(spark, (1, "ann", "2025-01-02", "2025-01-04"))
    feed = increments.change_feed(people, people, "2025-01-01")
    assert data.values(feed, "customer_id", "change_type") == [(1, "INSERT"), (1, "UPDATE")]


def test_latest_rows_without_updated_at(spark):
    df = spark.sql("SELECT id, timestamp_seconds(id) AS etl_processed_at FROM range(9)")
    assert [r.id for r in latest_rows(df, "id", 2).collect()] == [8, 7]


def test_sample_repeats_for_a_seed(spark):
    df = spark.range(1000)
    first = [r.id for r in sample_rows(df, "id", 5, seed=1).collect()]
    again = [r.id for r in sample_rows(df.repartition(7), "id", 5, seed=1).collect()]
    other = [r.id for r in sample_rows(df, "id", 5, seed=2).collect()]
    assert first == again != other and len(set(first)) == 5


def test_rows_without_a_stamp_are_read_once(spark):
    sold = data.orders(spark, data.order(1, "2025-01-01"), data.order(2, "2025-01-02"))
    stamp = F.when(F.col("order_id") != 1, F.col("updated_at"))
    mixed = sold.withColumn("updated_at", stamp)
    mark = increments.high_mark(mixed, "order_id")
    assert mark == Mark("2025-01-02 00:00:00", 2, 1)
    more = mixed.union(data.orders(spark, data.order(3, "2025-01-01")).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")))
    assert ids(increments.after_mark(more, mark, "order_id")) == [3]
    stored = Mark(mark.updated_at, "2", "1")
    assert increments.high_mark(more.where("order_id = 3"), "order_id").after(stored) == Mark("2025-01-02 00:00:00", "2", 3)


def test_lookback_reads_late_commits(spark):
    sold = data.orders(spark, *[data.order(i, f"2025-01-0{i}") for i in (1, 2, 3)])
    mark = Mark("2025-01-03 00:00:00", "3")
    assert ids(increments.after_mark(sold, mark, "order_id")) == []
    assert ids(increments.after_mark(sold, mark, "order_id", "1 days")) == [2, 3]
