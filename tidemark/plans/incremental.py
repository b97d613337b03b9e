"""Incremental loads of one table or of all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark import InheritableThread
from pyspark.sql import DataFrame

from tidemark.functions.audit import prepared
from tidemark.operators.catalog import table_profile
from tidemark.operators.increments import Mark, after_mark, backfill_or_since, late_rows, micro_batch
from tidemark.operators.lake import LakeTable
from tidemark.operators.watermarks import Watermarks
from tidemark.session import moved_to, session_like


# The key of each known table, and of any other.
KEYS = {"customers": "customer_id", "orders": "order_id"}
OTHER_KEY = "id"


def key_of(table: str) -> str:
    return KEYS.get(table, OTHER_KEY)


@dataclass(frozen=True)
class Run:
    """Outcome of one table's load; without new rows only ``rows_read`` is set.

    ``read_to`` is the batch's own last row, which a ``lookback`` can leave behind the mark.
    """

    table: str
    rows_read: int
    mark: Mark | None = None
    final_count: int | None = None
    latest: DataFrame | None = None
    manifest: str | None = None
    read_to: Mark | None = None


def load_increment(
    table: LakeTable,
    source: DataFrame,
    as_of: str | datetime,
    run_id: str,
    max_files: int = 10,
    unique: bool = False,
    verify: bool = False,
    lookback: str | None = None,
    first_days: int | None = None,
) -> Run:
    """Bring new and updated source rows into the table.

    A source with an enforced primary key is ``unique``, which saves a check.
    ``verify`` counts the table afterwards, which opens each of its files.
    ``lookback``, such as ``2 hours``, reads again what is stamped so long before the
    mark, for rows committed late; the merge leaves what it knows as it is.
    ``first_days`` limits a first load to rows updated within so many days.

    The mark moves last, and only to what the written batch holds. A run that
    fails before is repeated from the old mark, with the same result. So is one that
    finds at the end that another run has committed: it raises ``CommitConflict``, and
    its repetition starts from the other's mark.
    """
    marks = Watermarks(table.lake)
    before, version = marks.standing(table.short_name)
    if before is None and first_days is not None:
        source = backfill_or_since(source, None, as_of, first_days)
    batch = after_mark(source, before, table.key, lookback)
    done = table.upsert(prepared(batch, as_of, run_id), unique=unique)
    if not done.rows:
        return Run(table.short_name, 0)
    final_count, latest = table.count() if verify else None, table.latest()
    files = table.list_files(done.touched)
    if table.compact(max_files, within=done.touched, files=files):
        files = None
    manifest = table.write_manifest(done.touched, files)
    mark = done.mark.after(before)
    marks.commit(table.short_name, mark, run_id, version)
    return Run(table.short_name, done.rows, mark, final_count, latest, manifest, done.mark)


def load_in_steps(
    table: LakeTable,
    source: DataFrame,
    as_of: str | datetime,
    run_id: str,
    rows: int,
    lookback: str | None = None,
    first_days: int | None = None,
    **how,
) -> list[Run]:
    """Load a large increment ``rows`` at a time, each step with a mark of its own.

    A run that fails goes on behind the last step that was done. ``first_days`` cuts the
    source of a first load before its steps. With a ``lookback``, the rows from so long
    before the mark come first, in steps that leave the mark where it is; a run that fails
    among them reads them again.
    """
    marks, runs = Watermarks(table.lake), []
    before = marks.current(table.short_name)
    if before is None and first_days is not None:
        source = backfill_or_since(source, None, as_of, first_days)

    def step(batch: DataFrame) -> Run:
        runs.append(load_increment(table, batch, as_of, f"{run_id}_{len(runs) + 1}", lookback=lookback, **how))
        return runs[-1]

    if lookback is not None and before is not None and before.updated_at is not None:
        late = late_rows(source, before, table.key, lookback, how.get("unique", False))
        read_to = None
        while (run := step(micro_batch(late, read_to, table.key, rows))).rows_read:
            read_to = run.read_to
        runs.pop()  # the step that found none
    while step(micro_batch(source, marks.current(table.short_name), table.key, rows)).rows_read:
        pass
    return runs


@dataclass(frozen=True)
class AllRuns:
    runs: dict[str, Run]
    errors: dict[str, Exception]
    profile: DataFrame | None


def load_all(
    sources: Sequence[tuple[LakeTable, DataFrame]],
    as_of: str | datetime,
    run_id: str,
    unique: bool = False,
    verify: bool = False,
    lookback: str | None = None,
) -> AllRuns:
    """Load every table; refresh and profile the catalog only if all loads succeeded.

    The loads run at the same time, each in a session of its own, as they set the layout
    of their writes, and in a scheduler pool of its own, so that with
    ``spark.scheduler.mode=FAIR`` a small table does not wait for a large one. A failed
    table does not keep the others from loading. The loads themselves register new
    partitions and columns.
    """
    runs: dict[str, Run] = {}
    errors: dict[str, Exception] = {}

    def load(table: LakeTable, source: DataFrame) -> None:
        own = session_like(table.spark)
        own.sparkContext.setLocalProperty("spark.scheduler.pool", f"load_{table.short_name}")
        try:
            runs[table.short_name] = load_increment(
                table.under(own), moved_to(source, own), as_of, run_id, unique=unique, verify=verify, lookback=lookback
            )
        except Exception as error:  # noqa: BLE001 - reported per table
            errors[table.short_name] = error

    # Threads that carry their own scheduler pool and are stopped with the caller's job group.
    threads = [InheritableThread(target=load, args=source, session=source[0].spark) for source in sources]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        return AllRuns(runs, errors, None)
    spark = sources[0][0].spark
    for table, _ in sources:
        if table.exists():
            spark.catalog.refreshTable(table.name)
    found = {t.short_name: t.read() if t.exists() else None for t, _ in sources}
    return AllRuns(runs, errors, table_profile(spark, found))
