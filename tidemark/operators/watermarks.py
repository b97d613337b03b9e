"""Where each table's incremental reads stand.

A commit adds one entry, a file of one row that is named by its version, and the highest
version counts. The file is complete before it gets its name, and a name is given once,
so an interrupted commit leaves the mark before it in force, and of two commits that
follow the same version the second fails. That holds where a rename fails over an
existing file, as on HDFS. A reset adds an entry without a mark.
Each lake table has its own log, so runs of different tables never write to the
same folder.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.increments import Mark
from tidemark.operators.lake import Lake
from tidemark.sources.files import create_once

SCHEMA = (
    "table_name STRING, version BIGINT, updated_at STRING, last_key STRING, run_id STRING, "
    "unstamped_key STRING"
)
PREFIX = "etl_metadata_"


class CommitConflict(RuntimeError):
    """Another run has committed since this one read the mark."""


class Watermarks:
    def __init__(self, lake: Lake):
        self.lake = lake
        self.spark = lake.spark

    def current(self, table: str) -> Mark | None:
        return self.standing(table)[0]

    def standing(self, table: str) -> tuple[Mark | None, int]:
        """The current mark, and the version that a commit which builds on it names."""
        row = self._last(table)
        version = row["version"] if row else 0
        if row is None or row["last_key"] is None:
            return None, version
        return Mark(row["updated_at"], row["last_key"], row["unstamped_key"]), version

    def commit(self, table: str, mark: Mark, run_id: str, version: int | None = None) -> None:
        """Move the mark. With ``version``, only if that is still the last one.

        Otherwise :class:`CommitConflict` is raised and nothing has changed.
        """
        unstamped = None if mark.unstamped_key is None else str(mark.unstamped_key)
        self._add(table, mark.updated_at, str(mark.key), run_id, unstamped, version)

    def reset(self, table: str, run_id: str = "reset") -> None:
        """Forget the table's mark, so that the next run reads everything."""
        if self._last(table) is not None:
            self._add(table, None, None, run_id)

    def reset_all(self, run_id: str = "reset") -> None:
        for table in self._tables():
            self.reset(table, run_id)

    def list(self) -> DataFrame:
        """The current mark of every table that has one."""
        names = [self._name(t) for t in self._tables()]
        for name in names:
            self.spark.catalog.refreshTable(name)
        logs = [self.spark.table(name) for name in names]
        if not logs:
            return self.spark.createDataFrame([], SCHEMA)
        rest = F.struct("version", "updated_at", "last_key", "run_id", "unstamped_key")
        return (
            reduce(DataFrame.unionByName, logs)
            .groupBy("table_name")
            .agg(F.max(rest).alias("last"))
            .select("table_name", "last.*")
            .where(F.col("last_key").isNotNull())
        )

    def _name(self, table: str) -> str:
        return f"`{self.lake.database}`.`{PREFIX}{table}`"

    def _tables(self) -> list[str]:
        found = self.spark.sql(f"SHOW TABLES IN `{self.lake.database}` LIKE '{PREFIX}*'")
        return [r["tableName"].removeprefix(PREFIX) for r in found.collect()]

    def _last(self, table: str):
        if not self.spark.catalog.tableExists(self._name(table)):
            return None
        # Another application may have added entries since this one listed them.
        self.spark.catalog.refreshTable(self._name(table))
        return self.spark.table(self._name(table)).orderBy(F.desc("version")).first()

    def _add(
        self,
        table: str,
        updated_at: str | None,
        key: str | None,
        run_id: str,
        unstamped: str | None = None,
        version: int | None = None,
    ) -> None:
        name = self._name(table)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING json")
        if version is None:
            version = self.standing(table)[1]
        row = (table, version + 1, updated_at, key, run_id, unstamped)
        entry = json.dumps(dict(zip((c.split()[0] for c in SCHEMA.split(", ")), row)))
        folder = f"{self.lake.location}/{PREFIX}{table}"
        try:
            if not create_once(self.spark, f"{folder}/version-{version + 1:012d}.json", entry + "\n"):
                raise CommitConflict(f"{table} is past version {version} already")
        finally:
            self.spark.catalog.refreshTable(name)
