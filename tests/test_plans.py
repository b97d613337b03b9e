"""Plans that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F
from tidemark.functions.audit import with_date_parts
from tidemark.operators import increments, merge, ranking
from tidemark.operators.increments import Mark
from tidemark.plans import reports
from tidemark.plans.registry import QUERIES
from tidemark.session import session_conf
from tidemark.sources import tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_mark_predicate_reaches_the_scan(spark):
    orders = tables.order_rows(spark, FOLDER)
    text = details(increments.after_mark(orders, Mark("2000-01-01 00:00:00", "5"), "order_id"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "Or(" in pushed


def test_reports_read_only_their_columns(spark):
    text = details(QUERIES["top_products"](spark, FOLDER))
    assert "l_extendedprice" not in text and "p_brand" not in text and "o_totalprice" not in text


def test_orders_are_reduced_before_they_meet_customers(spark):
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(reports.customer_orders_summary(
            tables.customers(spark, FOLDER), tables.order_rows(spark, FOLDER)))
    join = text.index("LeftOuter")
    assert "partial_sum" in text[join:] and text[:join].count("Exchange") == 1


@pytest.mark.parametrize("name", ["top_products", "top5_products", "top5_customers"])
def test_top_rows_need_no_full_sort(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "TakeOrderedAndProject" in text


def test_micro_batch_is_a_filter(spark):
    """The cut is known by counting, so neither a sort nor a limit is left."""
    orders = tables.order_rows(spark, FOLDER)
    text = details(increments.micro_batch(orders, Mark("1999-12-31 00:00:00", 5), "order_id", 20))
    assert "TakeOrdered" not in text and "Sort" not in text and "Exchange" not in text
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "LessThan(o_orderdate" in pushed


def test_top_per_group_limits_before_the_shuffle(spark):
    orders = tables.order_rows(spark, FOLDER)
    text = plan(ranking.top_per_group(orders, "product_name", [F.desc("price")], 5))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_year_filter_prunes_partitions(spark, tmp_path):
    folder = str(tmp_path / "sales")
    with_date_parts(tables.order_rows(spark, FOLDER)).drop("day").write.partitionBy(
        "year", "month"
    ).parquet(folder)
    text = plan(reports.monthly_revenue(spark.read.parquet(folder), 1998))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1998\)\]", text)


WRITING = ("lake_", "incremental_", "schema_merge")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITING)))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text


def test_upsert_shuffles_each_side_once(spark):
    orders = tables.order_rows(spark, FOLDER)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(merge.upsert(orders, orders, "order_id"))
    assert text.count("Exchange hashpartitioning") == 3


def test_versions_of_a_key_are_reduced_before_the_shuffle(spark):
    orders = tables.order_rows(spark, FOLDER)
    text = plan(merge.latest_per_key(orders, "customer_id"))
    assert text.index("functions=[max(") < text.index("Exchange") < text.index("partial_max(")


def test_upsert_joins_one_row_per_key(spark):
    """The anti join sees each source key once, however many versions it has."""
    orders = tables.order_rows(spark, FOLDER)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(merge.upsert(orders, orders, "order_id"))
    right = text[text.index("LeftAnti") :].split("+- Sort")[1]
    assert right.count("HashAggregate") == 2
