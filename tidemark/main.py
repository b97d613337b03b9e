"""Command line for ``spark-submit``: load tables, manage marks, run reports.

The session's catalog must be persistent (a metastore) for tables and marks to
outlive the run.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.catalog import read_merged
from tidemark.operators.constraints import check_constraints
from tidemark.operators.increments import Mark
from tidemark.operators.lake import Lake
from tidemark.operators.results import save_result
from tidemark.operators.watermarks import Watermarks
from tidemark.plans.incremental import key_of, load_all
from tidemark.plans.reports import REPORTS
from tidemark.sources.jdbc import mark_condition, read_table


def parse(arguments: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("--database", required=True)
    parser.add_argument("--location", help="folder of the lake, for its first use")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="load new and updated rows of tables")
    load.add_argument("tables", nargs="+")
    source = load.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", help="folder with one Parquet folder per table")
    source.add_argument("--jdbc-url")
    load.add_argument("--jdbc-schema", default="public")
    load.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    load.add_argument("--jdbc-partitions", type=int, default=16, help="tasks that read a table")
    load.add_argument("--job-name", default="load")
    load.add_argument("--lookback", help="read again what is so much older than the mark, as '2 hours'")
    load.add_argument("--verify", action="store_true", help="count each table after its load")

    commands.add_parser("marks", help="show where each table's reads stand")
    reset = commands.add_parser("reset", help="forget marks, of all tables if none is named")
    reset.add_argument("tables", nargs="*")

    report = commands.add_parser("report", help="run a report and keep its result")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--results", required=True)
    report.add_argument("--rows", type=int, default=20, help="first rows to print")

    commands.add_parser("check", help="check the declared constraints")
    return parser.parse_args(arguments)


def _source(
    spark: SparkSession, options: argparse.Namespace, table: str, mark: Mark | None
) -> DataFrame:
    if options.files:
        return read_merged(spark, f"{options.files.rstrip('/')}/{table}")
    connection = dict(pair.split("=", 1) for pair in options.jdbc_option)
    name = f"{options.jdbc_schema}.{table}"
    key = key_of(table)
    where = None if options.lookback else mark_condition(mark, key)
    return read_table(
        spark, options.jdbc_url, name, key, options.jdbc_partitions, where, **connection
    )


def _print_all(df: DataFrame) -> None:
    """Every row, fetched partition by partition."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def _load(spark: SparkSession, lake: Lake, options: argparse.Namespace) -> int:
    now = datetime.now(UTC)
    run_id = f"{options.job_name}_{int(now.timestamp())}"
    marks = Watermarks(lake)
    sources = [
        (lake.table(t, key_of(t)), _source(spark, options, t, marks.current(t)))
        for t in options.tables
    ]
    unique = options.jdbc_url is not None
    done = load_all(
        sources, now, run_id, unique=unique, verify=options.verify, lookback=options.lookback
    )
    for run in done.runs.values():
        counted = "" if run.final_count is None else f", {run.final_count} in the table"
        print(f"{run.table}: {run.rows_read} rows read{counted}")
        if run.latest is not None:
            run.latest.show(truncate=False)
    for table, error in done.errors.items():
        print(f"{table}: failed: {error}")
    if done.profile is not None:
        _print_all(done.profile)
    return 1 if done.errors else 0


def main(arguments: Sequence[str] | None = None) -> int:
    options = parse(arguments)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    lake = Lake(spark, options.database, options.location)
    marks = Watermarks(lake)
    if options.command == "load":
        return _load(spark, lake, options)
    if options.command == "marks":
        _print_all(marks.list())
    elif options.command == "reset":
        for table in options.tables:
            marks.reset(table)
        if not options.tables:
            marks.reset_all()
    else:
        customers, orders = (lake.table(t, key_of(t)).read() for t in ("customers", "orders"))
        if options.command == "check":
            _print_all(check_constraints(customers, orders))
        else:
            found = REPORTS[options.name](customers, orders)
            folder = save_result(found, options.results, options.name)
            # Stored files carry no order, so the first rows are those of the report itself.
            rows = spark.read.parquet(folder).count()
            _print_all(found.limit(options.rows))
            print(f"{min(rows, options.rows)} of {rows} rows; all are in {folder}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
