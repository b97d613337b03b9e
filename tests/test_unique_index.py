import random

import data
import pytest
from pyspark.sql import functions as F
from test_lake import plan, staged
from tidemark.functions.audit import prepared
from tidemark.operators.lake import LakeTable

COLUMNS = "customer_id INT, email STRING, updated_at TIMESTAMP_NTZ"


def offer(spark, *rows):
    """Rows of (id, email), stamped by the id's day."""
    return prepared(
        spark.createDataFrame([(i, e, data.at(f"2025-01-{1 + abs(i) % 5:02d}")) for i, e in rows], COLUMNS), "2025-08-01 00:00:00", "run"
    )


def held(t):
    return data.values(t.read(), "customer_id", "email")


def test_random_offers_equal_a_plain_version(spark, lake):
    t, draw, want, taken, key = lake.table("people", "customer_id"), random.Random(3), [], set(), 0
    for _ in range(4):
        rows = []
        for _ in range(12):
            key += 1
            rows.append((key, draw.choice([None, *[f"e{n}" for n in range(25)]])))
        draw.shuffle(rows)
        added = t.insert_ignore(offer(spark, *rows), "email").rows
        fresh = []
        for i, e in sorted(rows):
            if e is None or e not in taken:
                fresh.append((i, e))
                taken |= {e} - {None}
        want += fresh
        assert added == len(fresh) and held(t) == sorted(want, key=repr)
        again = [(i + 1000 * key, e) for i, e in rows if e is not None]
        assert t.insert_ignore(offer(spark, *again), "email").rows == 0
    assert not staged(lake)
    index = spark.table(t.unique_index("email").name)
    assert sorted(r[0] for r in index.collect()) == sorted(taken)


def test_the_index_is_met_where_it_is(spark, lake):
    t = lake.table("people", "customer_id")
    t.create(offer(spark, *[(i, f"e{i}") for i in range(50)]), unique=True)
    t.insert_ignore(offer(spark, (100, "x"), (101, "e7")), "email")
    assert (100, "x") in held(t) and len(held(t)) == 51
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(t.unique_index("email").without_held(offer(spark, (200, "y")))).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange, for the offer; none above the scan of the index.
    assert text.count("Exchange hashpartitioning(email") == 1 and "Bucketed: true" in text


def test_values_that_an_upsert_frees_or_takes(spark, lake):
    t = lake.table("people", "customer_id")
    t.insert_ignore(offer(spark, (1, "a"), (2, "b")), "email")
    t.insert_ignore(offer(spark, (3, "a"), (4, None)), "email")
    t.upsert(offer(spark, (1, "c")))
    assert t.insert_ignore(offer(spark, (5, "a"), (6, "c"), (7, "b")), "email").rows == 1
    assert held(t) == [(1, "c"), (2, "b"), (4, None), (5, "a")]
    assert t.insert_ignore(offer(spark).limit(0), "email").rows == 0


def test_a_known_key_is_an_error(spark, lake):
    t = lake.table("people", "customer_id")
    t.insert_ignore(offer(spark, (1, "a"), (2, "b")), "email")
    for rows in ([(2, "new"), (3, "x")], [(7, "p"), (7, "q")]):
        with pytest.raises(ValueError, match="offered twice or is in"):
            t.insert_ignore(offer(spark, *rows), "email")
    assert held(t) == [(1, "a"), (2, "b")] and not staged(lake)
    assert t.insert_ignore(offer(spark, (2, "a"), (3, "new")), "email").rows == 1


def test_an_offer_that_died_is_finished(spark, lake, monkeypatch):
    t = lake.table("people", "customer_id")
    t.insert_ignore(offer(spark, (1, "a")), "email")
    t.insert_ignore(offer(spark, (2, "b")), "email")

    def die(*args):
        raise RuntimeError("died")

    with monkeypatch.context() as patched:
        patched.setattr(LakeTable, "_merge", die)
        with pytest.raises(RuntimeError, match="died"):
            t.insert_ignore(offer(spark, (3, "c")), "email")
    assert held(t) == [(1, "a"), (2, "b")]
    assert t.insert_ignore(offer(spark, (4, "c"), (5, "d")), "email").rows == 1
    assert held(t) == [(1, "a"), (2, "b"), (3, "c"), (5, "d")] and not staged(lake)
