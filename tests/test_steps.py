import data
from tidemark.operators.increments import Mark
from tidemark.operators.watermarks import Watermarks
from tidemark.plans.incremental import load_in_steps

NOW = "2025-08-01 00:00:00"


def test_first_days_hold_for_every_step(spark, lake):
    """The oldest rows fill whole steps, and are older than the window."""
    t = lake.table("orders", "order_id")
    old = [data.order(i, f"2024-01-0{i}") for i in range(1, 6)]
    recent = [data.order(i, f"2025-07-{i}") for i in range(11, 16)]
    source = data.orders(spark, *old, *recent)
    runs = load_in_steps(t, source, NOW, "run_1", 2, first_days=30)
    assert [r.rows_read for r in runs] == [2, 2, 1, 0]
    assert data.values(t.read(), "order_id") == [(i,) for i in range(11, 16)]
    assert [r.rows_read for r in load_in_steps(t, source, NOW, "run_2", 2, first_days=30)] == [0]


def test_late_rows_are_read_in_steps(spark, lake):
    """More late rows than a step holds, a late key with a later version, and new rows."""
    t, marks = lake.table("orders", "order_id"), Watermarks(lake)
    source = data.orders(spark, *[data.order(i, f"2025-07-1{i}") for i in range(1, 4)])
    load_in_steps(t, source, NOW, "run_1", 2)
    assert marks.current("orders") == Mark("2025-07-13 00:00:00", "3")
    late = [data.order(i, "2025-07-12T12:00") for i in (7, 8, 9)]
    changed = source.union(
        data.orders(
            spark, *late, data.order(6, "2025-07-01"), data.order(2, "2025-07-12T13:00", "1.00"),
            data.order(2, "2025-07-14", "2.00"), data.order(4, "2025-07-15"),
        )
    )
    runs = load_in_steps(t, changed, NOW, "run_2", 2, lookback="24 hours")
    assert [r.rows_read for r in runs] == [2, 2, 2, 0]
    assert data.values(t.read().where("price < 10"), "order_id", "price")[0][0] == 2
    assert [str(r[0]) for r in data.values(t.read().where("order_id = 2"), "price")] == ["2.00"]
    assert data.values(t.read(), "order_id") == [(i,) for i in (1, 2, 3, 4, 7, 8, 9)]
    assert marks.current("orders") == Mark("2025-07-15 00:00:00", "4")
