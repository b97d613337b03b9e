import threading

import data
import pytest
from tidemark.operators.increments import Mark
from tidemark.operators.watermarks import CommitConflict, Watermarks
from tidemark.plans.incremental import load_increment
from tidemark.sources.files import create_once, list_files

NOW = "2025-08-01 00:00:00"


def test_the_second_of_two_commits_on_a_version_fails(spark, lake):
    marks = Watermarks(lake)
    assert marks.standing("orders") == (None, 0)
    marks.commit("orders", Mark("2025-01-15 00:00:00", 1), "first", 0)
    with pytest.raises(CommitConflict):
        marks.commit("orders", Mark("2025-01-20 00:00:00", 2), "second", 0)
    assert marks.standing("orders") == (Mark("2025-01-15 00:00:00", "1"), 1)
    marks.reset("orders")
    with pytest.raises(CommitConflict):
        marks.commit("orders", Mark("2025-01-20 00:00:00", 2), "second", 1)
    assert marks.standing("orders") == (None, 2)
    marks.commit("orders", Mark(None, "it's \"7\"", 7), "third")
    assert marks.standing("orders") == (Mark(None, "it's \"7\"", "7"), 3)


def test_a_run_that_lost_the_race_repeats_without_loss(spark, lake, monkeypatch):
    """Another run commits while this one is between its merge and its commit."""
    t, commit = lake.table("orders", "order_id"), Watermarks.commit
    source = data.orders(spark, *[data.order(i, f"2025-01-{10 + i}") for i in range(1, 6)])
    load_increment(t, source.where("order_id <= 2"), NOW, "run_1")

    def late(self, *args):
        monkeypatch.setattr(Watermarks, "commit", commit)
        load_increment(t, source.where("order_id <= 4"), NOW, "other")
        commit(self, *args)

    monkeypatch.setattr(Watermarks, "commit", late)
    with pytest.raises(CommitConflict):
        load_increment(t, source, NOW, "run_2")
    assert Watermarks(lake).current("orders") == Mark("2025-01-14 00:00:00", "4")
    assert load_increment(t, source, NOW, "run_2").rows_read == 1
    assert [r[0] for r in data.values(t.read(), "order_id")] == [1, 2, 3, 4, 5]


def test_a_name_is_given_once(spark, tmp_path):
    """Many at once: one is told that it made the file, which is whole; none leaves anything else."""
    won = []

    def make(n):
        if create_once(spark, f"{tmp_path}/entry.json", f"{n}\n" * 1000):
            won.append(n)

    assert create_once(spark, f"{tmp_path}/first.json", "1") and not create_once(spark, f"{tmp_path}/first.json", "2")
    assert (tmp_path / "first.json").read_text() == "1"
    make(0)
    threads = [threading.Thread(target=make, args=(n,)) for n in range(1, 8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert won == [0] and (tmp_path / "entry.json").read_text() == "0\n" * 1000
    assert list_files(spark, str(tmp_path), "*.json").count() == 2
