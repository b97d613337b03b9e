"""Which values a lake table's unique column holds: a bucketed table of them.

An offer of new rows meets the index instead of the table, and does not move it. Values
are added once the rows that hold them are staged to be merged. An index can be dropped at
any time; it is then built anew from the table's column. That is done by what may free a
value, such as an upsert, and where a run has died.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.locator import BUCKET_KEYS, LEAST_BUCKETS


class UniqueIndex:
    def __init__(self, spark: SparkSession, database: str, table: str, column: str):
        self.spark = spark
        self.name = f"`{database}`.`unique_{table}__{column.lower()}`"
        self._next = f"`{database}`.`unique_{table}__{column.lower()}__next`"
        self.column = column

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def drop(self) -> None:
        for name in (self.name, self._next):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def build(self, values: DataFrame, rows: int) -> None:
        """Replace the index by the values; ``rows`` is about how many."""
        buckets = max(LEAST_BUCKETS, -(-rows // BUCKET_KEYS))
        self.drop()
        self._write(values, self._next, buckets, "errorifexists")
        self.spark.sql(f"ALTER TABLE {self._next} SET TBLPROPERTIES ('buckets' = '{buckets}')")
        # A run that dies in between leaves no index, so that the next one builds it.
        self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.name}")

    def add(self, values: DataFrame) -> None:
        held = self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('buckets')").first()["value"]
        self._write(values, self.name, int(held), "append")

    def without_held(self, offered: DataFrame) -> DataFrame:
        """The offered rows whose value the table does not hold; rows without one are left out."""
        named = offered.where(offered[self.column].isNotNull())
        return named.join(self.spark.table(self.name), self.column, "left_anti")

    def _write(self, values: DataFrame, name: str, buckets: int, mode: str) -> None:
        named = values.select(self.column).where(values[self.column].isNotNull())
        dealt = named.repartition(buckets, self.column)
        dealt.write.mode(mode).format("parquet").bucketBy(buckets, self.column).sortBy(self.column).saveAsTable(name)
