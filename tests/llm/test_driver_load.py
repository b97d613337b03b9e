"""What the driver keeps of each query that runs follows its plan: rounds are small and nothing runs for a count alone."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import stored_with
from tidemark.llm.components import components


def test_rounds_are_small_and_measured_as_they_are_stored(spark, monkeypatch):
    scans, stored = [], common.stored

    def counted(df, *more):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return stored(df, *more)

    def refused(self):
        raise AssertionError("a query of its own")

    links = spark.createDataFrame([(9, 4), (4, 7), (7, 2), (30, 31), (5, 5)], "a long, b long")
    with monkeypatch.context() as held:
        held.setattr(common, "stored", counted)
        held.setattr(DataFrame, "first", refused)
        held.setattr(DataFrame, "count", refused)
        found = components(links)
    assert sorted(map(tuple, found.collect())) == [(4, 2), (7, 2), (9, 2), (31, 30)]
    assert len(scans) > 2 and max(scans) <= 4


@pytest.mark.parametrize("edges", [[], [(3, 3)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(40)], [(50, i) for i in range(-9, 40)]])
def test_components_of_chains_and_stars(spark, edges):
    roots = {}
    for a, b in edges:
        low, high = sorted((roots.get(a, a), roots.get(b, b)))
        roots |= {a: low, b: low} | {node: low for node, root in roots.items() if root == high}
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted((n, r) for n, r in roots.items() if n != r)


def test_measures_of_stored_rows(spark):
    many = spark.range(1000).repartition(7)
    none = many.where("id < 0").distinct()
    for df, rows, total in ((many, 1000, 499500), (none, 0, None)):
        kept, measures = stored_with(df, "measured", F.count("*"), F.sum("id"))
        assert measures == [rows, total]
        assert kept.count() == rows
