"""Lake tables: partitioned Parquet tables in the catalog that take keyed changes.

Plain Parquet has no MERGE, so a batch is applied per partition, in steps that
can all be repeated. New partitions are written, rows for partitions without a
match are appended, and partitions that hold matches are computed anew into a
staging table in the shared folder, then swapped in by a dynamic partition
overwrite. The batch itself stays registered until all is done: a run that dies is
finished by the next one, which completes its swap and merges its batch once more.
Compaction packs a partition's small files and leaves its large ones where they are.
A locator of keys, kept with the merges, tells which partitions hold matches.
There must be one writer per table; readers may see a swap half done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterable
from copy import copy
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField

from tidemark.functions.columns import PARTITION_COLUMNS, partition_key
from tidemark.operators.increments import Summary, observed, summarize
from tidemark.operators.locator import KeyLocator
from tidemark.operators.merge import first_per_value, latest_per_key, without_stale
from tidemark.operators.packing import crowded, packed_bins, small_bytes
from tidemark.operators.ranking import latest_rows
from tidemark.operators.unique_index import UniqueIndex
from tidemark.session import few_listing_tasks, session_conf, shared_dir
from tidemark.sources.files import list_partition_files, move_files, remove_file, remove_folder

# Size to which written files are laid out.
TARGET_FILE_BYTES = 128 * 1024 * 1024

# Shuffled rows take at least twice their space in Parquet.
SHUFFLED_BYTES_PER_FILE = 2 * TARGET_FILE_BYTES

# Integer keys up to this number make a hash table of less than 100 MB.
BROADCAST_KEYS = 2_000_000

# More folders than this are listed by the folders above them.
LISTED_FOLDERS = 32

DYNAMIC_OVERWRITE = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def _listing_tuned(method: Callable) -> Callable:
    @wraps(method)
    def tuned(self, *args, **kwargs):
        with few_listing_tasks(self.spark):
            return method(self, *args, **kwargs)

    return tuned


class Lake:
    """A database of lake tables and the staging database beside it."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        self.staging = f"{database}_staging"
        at = f"LOCATION '{location.rstrip('/')}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` {at}")
        if not spark.catalog.databaseExists(self.staging):
            scratch = f"{shared_dir(spark)}/{self.staging}-{uuid.uuid4().hex}"
            spark.sql(f"CREATE DATABASE `{self.staging}` LOCATION '{scratch}'")

    @property
    def location(self) -> str:
        return self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")

    def table(self, name: str, key: str) -> LakeTable:
        return LakeTable(self, name, key)

    def under(self, spark: SparkSession) -> Lake:
        """The same lake, worked on under another session of the application."""
        other = copy(self)
        other.spark = spark
        return other

    def drop(self) -> None:
        for database in (self.database, self.staging):
            self.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


class LakeTable:
    """One table, partitioned by the day of ``updated_at`` and keyed by ``key``."""

    def __init__(self, lake: Lake, name: str, key: str):
        self.lake = lake
        self.spark = lake.spark
        self.short_name = name.lower()
        self.name = f"`{lake.database}`.`{self.short_name}`"
        self.manifest = f"`{lake.database}`.`manifest_{self.short_name}`"
        self.key = key
        self.locator = KeyLocator(lake.spark, lake.database, self.short_name, key)

    def under(self, spark: SparkSession) -> LakeTable:
        """The same table, worked on under another session of the application."""
        return LakeTable(self.lake.under(spark), self.short_name, self.key)

    # Reading

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def is_empty(self) -> bool:
        """True before the first load, and after one that died before it was done."""
        return not self.exists() or self.partitions().isEmpty()

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    @_listing_tuned
    def count(self) -> int:
        return self.read().count()

    @property
    def location(self) -> str:
        return f"{self.lake.location}/{self.short_name}"

    def partitions(self) -> DataFrame:
        """The partitions in the catalog with their ``yyyymmdd`` number."""
        spec = F.col("partition")
        values = {
            c: F.expr(f"try_cast(regexp_extract(partition, '{c}=([^/]+)', 1) AS INT)")
            for c in PARTITION_COLUMNS
        }
        return (
            self.spark.sql(f"SHOW PARTITIONS {self.name}")
            .withColumns(values)
            .withColumn("number", partition_key())
            .select(spec, *PARTITION_COLUMNS, "number")
        )

    def latest(self, k: int = 5) -> DataFrame:
        """The ``k`` latest rows.

        Partitions follow the sort column and none is empty, so the newest ``k``
        partitions hold them all; older ones are pruned.
        """
        newest = self.partitions().orderBy(F.desc("number")).limit(k).collect()
        return latest_rows(self.read().where(_in_partitions(_numbers(newest))), self.key, k)

    # Writing

    @_listing_tuned
    def create(self, df: DataFrame, unique: bool = False) -> Summary:
        """Write the first content, in one pass over ``df``.

        Unless the keys are known to be ``unique``, repeated ones are looked for
        in the written table and reduced to their latest row.
        """
        if not self.is_empty():
            raise ValueError(f"{self.name} has rows already")
        self.locator.drop()
        self._drop_indexes()
        if self.exists():
            self._add_columns(df)
        else:
            columns = ", ".join(_column_ddl(f) for f in df.schema)
            self.spark.sql(
                f"CREATE TABLE {self.name} ({columns}) USING parquet "
                f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)})"
            )
        if unique:
            return self._insert(df, overwrite=True)
        self._insert(df, overwrite=True, look=False)
        summary = summarize(self.read(), self.key)
        if summary.repeated:
            self._reduce_repeated()
        return summary

    @_listing_tuned
    def upsert(
        self, batch: DataFrame, only_newer: bool = False, unique: bool = False
    ) -> Summary:
        """Replace rows by key and insert new ones; create the table if missing.

        The rows must carry the partition columns. With ``only_newer``, rows older
        than the table's are left out. Of a key that repeats in the batch the latest row counts; ``unique`` says
        that none does. Running the same batch again leaves the same rows.
        """
        if self.is_empty():
            return Summary.empty() if batch.isEmpty() else self.create(batch, unique)
        self.finish_interrupted()
        # The batch may free values of unique columns, or take some.
        self._drop_indexes()
        return self._merge_staged(batch, only_newer, unique)

    @_listing_tuned
    def insert_ignore(self, offered: DataFrame, unique: str) -> Summary:
        """Add the rows whose value of the ``unique`` column is new; the others are ignored.

        Of several rows with one value that with the lowest key is added, and rows without
        a value are all added, as NULL never equals NULL. The rows must carry the partition
        columns. Keys must be new: one that the table has, or that is offered twice, is an
        error, and nothing is added then. The values are looked up in an index, which the
        first offer builds; the table itself is not read. Offering the same rows again adds
        none of those that have a value.
        """
        index = self.unique_index(unique)
        if self.is_empty():
            index.drop()
            fresh = first_per_value(offered, unique, self.key)
        else:
            self.finish_interrupted()
            if not index.exists():
                values = self.read().select(unique)
                index.build(values, values.count())
            unnamed = offered.where(F.col(unique).isNull())
            fresh = first_per_value(index.without_held(offered), unique, self.key).unionByName(unnamed)
        run = uuid.uuid4().hex
        rows = self.spark.table(self._stage("batch", fresh, run))
        summary = replace(summarize(rows, self.key), staged=run)
        try:
            if summary.rows and (summary.repeated or self._holds_keys(rows, summary)):
                raise ValueError(f"a {self.key} of a new {unique} is offered twice or is in {self.name} already")
            if summary.rows and self.is_empty():
                return self.create(rows, unique=True)
            if summary.rows:
                # A run that dies from here on is finished by the next one, which drops the index.
                self._stage("merge", self.spark.createDataFrame([(summary.rows,)], "rows BIGINT"), run)
                index.add(rows)
                summary = replace(summary, touched=self._merge(rows, summary))
                self._drop_staged("merge", run)
                self.locator.settle()
            return summary
        finally:
            if run not in self._staged("merge"):
                self._drop_staged("batch", run)

    def unique_index(self, column: str) -> UniqueIndex:
        return UniqueIndex(self.spark, self.lake.database, self.short_name, column)

    def _holds_keys(self, rows: DataFrame, summary: Summary) -> bool:
        """Whether the table has one of the rows' keys; only partitions that may have are read."""
        held = set() if self.is_empty() else self._partitions_holding(rows, summary)
        if not held:
            return False
        inside = self.read().where(_in_partitions(held))
        return not inside.join(self._keys(rows, summary), self.key, "left_semi").isEmpty()

    def _drop_indexes(self) -> None:
        prefix = f"unique_{self.short_name}__"
        found = self.spark.sql(f"SHOW TABLES IN `{self.lake.database}` LIKE '{prefix}*'")
        for row in found.collect():
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.lake.database}`.`{row['tableName']}`")

    @_listing_tuned
    def refresh(self, df: DataFrame, unique: bool = False) -> None:
        """Replace the whole content."""
        if self.is_empty():
            self.create(df, unique)
            return
        self.finish_interrupted()
        self.locator.drop()
        self._drop_indexes()
        self._add_columns(df)
        rows = df if unique else latest_per_key(df, self.key)
        self._replace(rows, _numbers(self.partitions().collect()))

    @_listing_tuned
    def compact(
        self,
        max_files: int = 10,
        target_bytes: int = TARGET_FILE_BYTES,
        within: Collection[int] | None = None,
        files: DataFrame | None = None,
    ) -> int:
        """Pack small files when there are more than ``max_files`` files.

        Partitions whose small files average well below the target size get them packed
        into files of about that size; other files are neither read nor moved.
        With ``within`` only the numbered partitions are looked at, so that the work
        after a batch follows the batch; ``files`` is their listing, if it is known.
        Returns how many partitions were packed.
        """
        files = self.list_files(within) if files is None else files
        if files.count() <= max_files:
            return 0
        if crowded(files, target_bytes).isEmpty():
            return 0
        if self.finish_interrupted():
            files = self.list_files(within)
        return self._pack(crowded(files, target_bytes), target_bytes)

    @_listing_tuned
    def write_manifest(self, within: Collection[int] | None = None, files: DataFrame | None = None) -> str:
        """List the table's data files as text, a folder per month.

        With ``within`` only the lines of the numbered partitions are replaced, or
        dropped for those that are gone; ``files`` is their listing, if it is known.
        Returns the folder.
        """
        if not self.spark.catalog.tableExists(self.manifest):
            within, files = None, None if within is not None else files
            self.spark.sql(
                f"CREATE TABLE {self.manifest} (path STRING, month INT) USING text "
                "PARTITIONED BY (month)"
            )
        files = self.list_files(within) if files is None else files
        month = F.expr("number DIV 100").cast("int").alias("month")
        lines = files.select("path", month)
        listed = self.spark.sql(f"SHOW PARTITIONS {self.manifest}").select(
            F.expr("CAST(split_part(partition, '=', 2) AS INT)").alias("month")
        )
        months = {r["month"] for r in listed.collect()}
        staged = None
        if within is not None:
            months &= {n // 100 for n in within}
            known = self.spark.table(self.manifest).where(F.col("month").isin(sorted(months)))
            kept = (
                known.withColumn("number", _number_in("path"))
                .join(self._numbered(within), "number", "left_anti")
                .select("path", "month")
            )
            # The lines that stay are read from what is about to be replaced.
            staged = uuid.uuid4().hex
            lines = self.spark.table(self._stage("lines", kept.union(lines), staged))
        with session_conf(self.spark, DYNAMIC_OVERWRITE):
            lines.repartition("month").write.insertInto(self.manifest, overwrite=True)
        gone = months - {r["month"] for r in lines.select("month").distinct().collect()} if months else set()
        if gone:
            specs = ", ".join(f"PARTITION (month = {m})" for m in sorted(gone))
            self.spark.sql(f"ALTER TABLE {self.manifest} DROP IF EXISTS {specs}")
        if staged:
            self._drop_staged("lines", staged)
        return f"{self.lake.location}/manifest_{self.short_name}"

    def finish_interrupted(self) -> bool:
        """Complete the merge or packing of a run that died, and drop what else it staged.

        Its swap is done first, if it was ready. Merging its batch again finds the rows
        that it had already added by their keys, so none is there twice. Returns whether
        there was anything.
        """
        kinds = ("packed", "bins", "plan", "rows", "merge", "batch", "lines")
        runs = {kind: self._staged(kind) for kind in kinds}
        # A packing comes first: rows that are there twice would be merged twice.
        for run in runs["packed"]:
            self._publish_packed(run)
        for run in runs["bins"]:
            if run not in runs["packed"]:
                remove_folder(self.spark, self._packed_folder(run))
                self._drop_staged("bins", run)
        for run in runs["plan"]:
            self._publish(run)
        for run in runs["rows"]:
            if run not in runs["plan"]:
                self._drop_staged("rows", run)
        if runs["merge"]:
            self._drop_indexes()
        for run in runs["merge"]:
            if run in runs["batch"]:
                rows = self.spark.table(self._staged_name("batch", run))
                self._merge(rows, replace(summarize(rows, self.key, unique=True), staged=run))
            self._drop_staged("merge", run)
        for kind in ("batch", "lines"):
            for run in runs[kind]:
                self._drop_staged(kind, run)
        return any(runs.values())

    def list_files(self, within: Collection[int] | None = None) -> DataFrame:
        """The table's files; folders that are no partition of it do not count.

        With ``within`` those of the numbered partitions. The folders are listed when
        this is called, and not again when the result is used.
        """
        known = self.partitions()
        if within is None:
            files = list_partition_files(self.spark, self.location)
        else:
            known = known.join(self._numbered(within), "number", "left_semi")
            folders = [r["partition"] for r in known.collect()]
            if not folders:
                return self.spark.createDataFrame([], "path STRING, length BIGINT, number INT")
            files = list_partition_files(self.spark, self.location, _few_folders(folders))
        return files.withColumn("number", partition_key()).join(
            F.broadcast(known.select("number")), "number", "left_semi"
        )

    def _numbered(self, numbers: Collection[int]) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame([(n,) for n in sorted(numbers)], "number INT"))

    # Steps of a merge

    def _merge_staged(self, batch: DataFrame, only_newer: bool, unique: bool) -> Summary:
        """Merge a batch from a staged copy, so that its source is read once."""
        runs: list[str] = []

        def staged(df: DataFrame) -> DataFrame:
            runs.append(uuid.uuid4().hex)
            return self.spark.table(self._stage("batch", df, runs[-1]))

        watched, look = observed(batch, self.key)
        rows = staged(watched)
        summary = look()
        if summary is None or not unique:
            summary = summarize(rows, self.key, unique)
        if summary.repeated:
            rows = staged(latest_per_key(rows, self.key))
        if summary.rows and only_newer:
            near = F.col(self.key).between(summary.low_key, summary.high_key)
            rows = staged(without_stale(rows, self.read().where(near), self.key))
        if summary.rows:
            # From here on a run that dies is merged again by the next one.
            self._stage("merge", self.spark.createDataFrame([(summary.rows,)], "rows BIGINT"), runs[-1])
            summary = replace(summary, staged=runs[-1])
            summary = replace(summary, touched=self._merge(rows, summary))
            self._drop_staged("merge", runs[-1])
            self.locator.settle()
        for run in runs:
            self._drop_staged("batch", run)
        return summary

    def _reduce_repeated(self) -> None:
        """Merge the latest row of every repeated key over all its rows."""
        latest = latest_per_key(self.read(), self.key, repeated_only=True)
        self._merge_staged(latest, only_newer=False, unique=True)

    def _merge(self, rows: DataFrame, summary: Summary) -> frozenset[int]:
        """Apply a batch with one row per key; the numbers of the partitions it changed."""
        self._add_columns(rows)
        target = set(_numbers(rows.select(partition_key().alias("number")).distinct().collect()))
        known = set(_numbers(self.partitions().collect()))
        held = self._partitions_holding(rows, summary) & known
        # The dearest step comes first: nothing has changed if it fails.
        swap = None
        if held:
            inside = _in_partitions(held)
            kept = self.read().where(inside).join(self._keys(rows, summary), self.key, "left_anti")
            content = kept.unionByName(rows.where(inside), allowMissingColumns=True)
            swap = self._stage_replacement(content, held)
        self.locator.add(rows.select(self.key, partition_key().alias("number")), summary.staged)
        # Overwriting new partitions clears what a run that died may have left there.
        if new := target - known:
            self._insert(rows.where(_in_partitions(new)), overwrite=True, look=False)
        if grown := (target & known) - held:
            self._insert(rows.where(_in_partitions(grown)), overwrite=False, look=False)
        if swap:
            self._publish(swap)
        return frozenset(target | held)

    def _partitions_holding(self, rows: DataFrame, summary: Summary) -> set[int]:
        """Numbers of the partitions that may have a row that the batch replaces.

        Only the locator is read, once it is there. The result is at most one number
        per partition.
        """
        if not self.locator.exists():
            entries = self.read().select(self.key, partition_key().alias("number"))
            self.locator.build(entries, self.count())
        found = self.locator.holding(
            self._keys(rows, summary), summary.rows, summary.low_key, summary.high_key, summary.staged
        )
        return set(_numbers(found.collect()))

    def _keys(self, rows: DataFrame, summary: Summary) -> DataFrame:
        """The keys of a batch, broadcast if they are few and of fixed width.

        That spares a shuffle of the table's rows. More keys are joined by shuffle,
        unless Spark finds them small enough.
        """
        keys = rows.select(self.key)
        fixed = isinstance(keys.schema[0].dataType, IntegralType)
        return F.broadcast(keys) if fixed and summary.rows <= BROADCAST_KEYS else keys

    def _insert(self, rows: DataFrame, overwrite: bool, look: bool = True) -> Summary | None:
        """Add rows; with ``overwrite`` the partitions they fall in are replaced.

        With ``look`` the write itself tells their size, key range and mark, for keys
        that do not repeat.
        """
        ordered = self._in_table_order(_by_partition(rows))
        seen = None
        if look:
            ordered, seen = observed(ordered, self.key)
        with session_conf(rows.sparkSession, _layout_settings() | DYNAMIC_OVERWRITE):
            ordered.write.insertInto(self.name, overwrite)
        if look:
            return seen() or summarize(self.read(), self.key, unique=True)
        return None

    def _replace(self, content: DataFrame, numbers: Iterable[int]) -> None:
        """Make ``content`` the only rows of the numbered partitions."""
        self._publish(self._stage_replacement(content, numbers))

    def _stage_replacement(self, content: DataFrame, numbers: Iterable[int]) -> str:
        """Stage the new rows of the numbered partitions; the swap is ready then."""
        run = uuid.uuid4().hex
        ordered = _by_partition(content).sortWithinPartitions(*PARTITION_COLUMNS)
        staged = self.spark.table(self._stage("rows", ordered, run))
        filled = set(_numbers(staged.select(partition_key().alias("number")).distinct().collect()))
        emptied = [(n,) for n in numbers if n not in filled]
        # The plan is registered last: if it is there, the staged rows are whole.
        self._stage("plan", self.spark.createDataFrame(emptied, "number INT"), run)
        return run

    def _publish(self, run: str) -> None:
        rows = self._in_table_order(self.spark.table(self._staged_name("rows", run)))
        with session_conf(self.spark, DYNAMIC_OVERWRITE):
            rows.write.insertInto(self.name, overwrite=True)
        emptied = set(_numbers(self.spark.table(self._staged_name("plan", run)).collect()))
        if emptied:
            self._drop_partitions(emptied)
        self._drop_staged("plan", run)
        self._drop_staged("rows", run)

    # Steps of a packing

    def _packed_folder(self, run: str) -> str:
        """Where packed files wait: beside the partitions, under a name that no read sees."""
        return f"{self.location}/_packed_{run}"

    def _pack(self, small: DataFrame, target_bytes: int) -> int:
        """Write the small files' rows as fewer files, then put these in their place."""
        run = uuid.uuid4().hex
        bins = self.spark.table(self._stage("bins", packed_bins(small, target_bytes), run))
        numbers = _numbers(bins.select("number").distinct().collect())
        if numbers:
            # Spark leaves out files by their size before it reads any.
            rows = self.read().where(_in_partitions(numbers) & (F.col("_metadata.file_size") < small_bytes(target_bytes)))
            named = rows.select("*", F.col("_metadata.file_name").alias("pack_file"), partition_key().alias("pack_number"))
            dealt = bins.select(
                F.col("number").alias("pack_number"), F.col("name").alias("pack_file"), F.col("bin").alias("pack_bin")
            )
            content = named.join(dealt, ["pack_number", "pack_file"]).drop("pack_file", *PARTITION_COLUMNS)
            # A bin has the target size at most, so a task can hold it.
            content = content.repartition("pack_number", "pack_bin")
            content.write.partitionBy("pack_number", "pack_bin").parquet(self._packed_folder(run))
            written = self.spark.read.parquet(self._packed_folder(run)).select("pack_number", "pack_bin").distinct()
            if written.count() != bins.select("number", "bin").distinct().count():
                raise RuntimeError(f"the listed files of {self.name} are not those that are read")
            # Registered last: if it is there, the packed files are whole.
            self._stage("packed", self.spark.createDataFrame([(len(numbers),)], "partitions INT"), run)
            self._publish_packed(run)
        else:
            self._drop_staged("bins", run)
        return len(numbers)

    def _publish_packed(self, run: str) -> None:
        """Move packed files to their partitions and delete what they were made of.

        Each step can be repeated. Rows are twice there in between, but never gone.
        """
        bins = self.spark.table(self._staged_name("bins", run))
        folders = bins.groupBy("number", "bin").agg(F.first("folder").alias("folder"))
        for row in folders.toLocalIterator():
            staged = f"{self._packed_folder(run)}/pack_number={row['number']}/pack_bin={row['bin']}"
            move_files(self.spark, staged, row["folder"], f"packed-{run}-{row['bin']}")
        for row in bins.select("folder", "name").toLocalIterator():
            remove_file(self.spark, f"{row['folder']}/{row['name']}")
        remove_folder(self.spark, self._packed_folder(run))
        self.spark.catalog.refreshTable(self.name)
        self._drop_staged("packed", run)
        self._drop_staged("bins", run)

    def _drop_partitions(self, numbers: set[int]) -> None:
        gone = self.partitions().where(F.col("number").isin(list(numbers))).collect()
        specs = []
        for row in gone:
            parts = [f"{c} = {'NULL' if row[c] is None else row[c]}" for c in PARTITION_COLUMNS]
            specs.append(f"PARTITION ({', '.join(parts)})")
        if specs:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(specs)}")

    def _add_columns(self, rows: DataFrame) -> None:
        known = {c.lower() for c in self.read().columns}
        new = [f for f in rows.schema if f.name.lower() not in known]
        if new:
            columns = ", ".join(_column_ddl(f) for f in new)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({columns})")

    def _in_table_order(self, df: DataFrame) -> DataFrame:
        """Columns by the table's order; those missing become NULL."""
        given = {c.lower() for c in df.columns}
        return df.select(
            *[
                F.col(f"`{f.name}`")
                if f.name.lower() in given
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in self.read().schema
            ]
        )

    # Staging tables

    def _staged_name(self, kind: str, run: str) -> str:
        return f"`{self.lake.staging}`.`{self.short_name}__{kind}__{run}`"

    def _stage(self, kind: str, df: DataFrame, run: str | None = None) -> str:
        """Write a table that cuts lineage; it is registered once it is complete."""
        name = self._staged_name(kind, run or uuid.uuid4().hex)
        with session_conf(df.sparkSession, _layout_settings()):
            df.write.format("parquet").saveAsTable(name)
        return name

    def _staged(self, kind: str) -> list[str]:
        prefix = f"{self.short_name}__{kind}__"
        found = self.spark.sql(f"SHOW TABLES IN `{self.lake.staging}` LIKE '{prefix}*'")
        return [r["tableName"].removeprefix(prefix) for r in found.collect()]

    def _drop_staged(self, kind: str, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._staged_name(kind, run)}")


def _by_partition(df: DataFrame) -> DataFrame:
    """Bring each partition's rows together; adaptive execution splits large ones.

    With at least two shuffle partitions per core, few days share one, so that a
    split does not cut several days into small files.
    """
    spark = df.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        2 * spark.sparkContext.defaultParallelism,
    )
    return df.hint("rebalance", tasks, *[F.col(c) for c in PARTITION_COLUMNS])


def _layout_settings() -> dict[str, str]:
    """Settings for writes that follow :func:`_by_partition`.

    Small shuffle partitions are not joined: they hold different days, so joining
    them would save no file and cost parallel writers.
    """
    return {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLED_BYTES_PER_FILE),
    }


def _column_ddl(field: StructField) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def _number_in(path: str) -> Column:
    """The ``yyyymmdd`` number of the partition that a file's path names."""
    year, month, day = (F.expr(f"try_cast(regexp_extract({path}, '/{c}=([^/]+)/', 1) AS INT)") for c in PARTITION_COLUMNS)
    return F.coalesce(year * 10000 + month * 100 + day, F.lit(0))


def _few_folders(folders: list[str]) -> list[str] | None:
    """Folders to list for these partitions: themselves, their months, or all there are."""
    if len(folders) <= LISTED_FOLDERS:
        return folders
    months = sorted({f.rsplit("/", 1)[0] for f in folders})
    return months if len(months) <= LISTED_FOLDERS else None


def _in_partitions(numbers: Iterable[int]) -> Column:
    return partition_key().isin(sorted(numbers))


def _numbers(rows: Iterable[Row]) -> list[int]:
    return [r["number"] for r in rows]
