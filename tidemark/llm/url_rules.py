"""URL allow and block rules by a sort-merge range join over reversed hosts.

A host is written backwards, label by label: ``www.example.com`` becomes the key
``com.example.www.``. All subdomains of a host then share its key as a prefix, so
a rule on a host is an interval of keys, and intervals of rules nest. One sorted
sweep over urls and interval ends keeps the stack of rules that are open. The
longest rule on the stack whose path starts the url's path decides.

The sweep is cut by a range partitioning on (key, hash of the row), so a host with
a third of all urls is spread over many ranges; every range starts with the stack
that the ranges before it left open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

RULE_COLUMNS = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def _key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _events(rules: DataFrame) -> DataFrame:
    """The stack of open rules at each place where an interval begins or ends."""
    rules = (
        rules.select(
            F.coalesce(ascii_lower(F.col("host")), F.lit("")).alias("host"),
            F.coalesce(F.col("path"), F.lit("")).alias("path"),
            F.col("verdict"),
        )
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    rule = F.concat("host", "path")
    open_rules = rules.groupBy("host").agg(
        F.collect_list(F.struct(F.char_length(rule).alias("size"), rule.alias("rule"), "path", "verdict")).alias("own")
    )
    labels = F.split("host", r"\.", -1)
    upper = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("above")
    lines = open_rules.select("host", upper).join(
        open_rules.select(F.col("host").alias("above"), "own"), "above"
    )
    stacks = lines.groupBy("host").agg(
        F.flatten(F.collect_list("own")).alias("inside"),
        F.flatten(F.collect_list(F.when(F.col("above") != F.col("host"), F.col("own")))).alias("after"),
    )
    key = _key(F.col("host"))
    begin = stacks.select(key.alias("key"), F.col("inside").alias("stack"))
    # "/" is the character after ".", so this is the first key beyond the prefix.
    end = stacks.select(F.regexp_replace(key, r"\.$", "/").alias("key"), F.col("after").alias("stack"))
    return begin.union(end)


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per page: its id, host, path, the rule that decides, and the verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if
    the url's path starts with the rule's; of several the longest wins. Where none
    fits, ``rule`` is null and the verdict is ``default``.

    Null urls, and urls without ``://``, have empty host and path, which only a rule
    on the empty host fits. Repeated rows stay. A rule given twice with two verdicts
    counts as the later one by alphabet. No pages give no rows; no rules give the
    default throughout. Other columns are ignored, whatever their names.
    """
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    events = _events(rules)
    kind = events.schema["stack"].dataType
    rows = urls.select(
        _key(F.col("host")).alias("key"), F.lit(1).alias("turn"), F.xxhash64("id", "path").alias("salt"),
        "id", "host", "path", F.lit(None).cast(kind).alias("stack"),
    ).unionByName(
        events.select("key", F.lit(0).alias("turn"), F.lit(0).cast("long").alias("salt"), "stack"), allowMissingColumns=True
    )
    # Written once, so that all that follows sees the same ranges.
    ranged = stored(
        rows.repartitionByRange("key", "turn", "salt").withColumn("range", F.spark_partition_id()), "url-ranges"
    )
    # The stack that each range leaves open, then the one it starts with. One row per range.
    left_open = ranged.groupBy("range").agg(
        F.max_by("stack", F.when(F.col("turn") == 0, F.col("key"))).alias("leaves")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = left_open.select(
        F.col("range").alias("at"), F.last("leaves", ignorenulls=True).over(before).alias("carried")
    )
    sweep = Window.partitionBy("range").orderBy("key", "turn", "salt").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        ranged.join(carried, F.col("range") == F.col("at"), "left")
        .withColumn("open", F.coalesce(F.last("stack", ignorenulls=True).over(sweep), "carried"))
        .where(F.col("turn") == 1)
    )
    fitting = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(fitting)
    return swept.withColumn("best", best).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_COLUMNS)
