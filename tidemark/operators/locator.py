"""Where a lake table's keys are: a bucketed table of keys and partition numbers.

A merge has to know which partitions hold rows that its batch replaces. The locator
has an entry for every key, bucketed and sorted by it, so a batch meets it without
moving it and without opening the table. Each merge adds the entries of its batch as
a new generation; of a key the last generation counts. Entries are added before
the rows they speak of, so a run that dies leaves entries too many, never too few:
those of a run that is being repeated count beside the generation before.

The locator can be dropped at any time; it is then built anew from the table's keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Keys in a bucket when the locator is built, and buckets at least.
BUCKET_KEYS = 4_000_000
LEAST_BUCKETS = 8

# So few keys are looked up by value, which reads only their buckets.
POINT_KEYS = 1_000

# After so many generations the last entries are written together.
GENERATIONS = 32

BUILT = "built"


class KeyLocator:
    def __init__(self, spark: SparkSession, database: str, table: str, key: str):
        self.spark = spark
        self.short_name = f"locator_{table}"
        self.name = f"`{database}`.`{self.short_name}`"
        self._next = f"`{database}`.`{self.short_name}_next`"
        self.key = key

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def drop(self) -> None:
        for name in (self.name, self._next):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def build(self, entries: DataFrame, rows: int) -> None:
        """Replace the locator by the given keys and numbers; ``rows`` is about how many."""
        buckets = max(LEAST_BUCKETS, -(-rows // BUCKET_KEYS))
        self.spark.sql(f"DROP TABLE IF EXISTS {self._next}")
        self._write(self._entries(entries, 0, BUILT), self._next, buckets, "errorifexists")
        self.spark.sql(f"ALTER TABLE {self._next} SET TBLPROPERTIES ('generation' = '0', 'buckets' = '{buckets}')")
        # A run that dies in between leaves no locator, so that the next one builds it.
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.name}")

    def add(self, entries: DataFrame, run: str) -> None:
        """Add a batch's keys with the numbers of the partitions they go to."""
        generation, buckets = self._property("generation") + 1, self._property("buckets")
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('generation' = '{generation}')")
        self._write(self._entries(entries, generation, run), self.name, buckets, "append")

    def settle(self) -> None:
        """After many generations, keep the last entries only. No run may be under way."""
        if self._property("generation") >= GENERATIONS:
            entries = self.spark.table(self.name)
            last = self._last(entries).select(self.key, "number")
            self.build(last, entries.count())

    def holding(self, keys: DataFrame, rows: int, low, high, run: str) -> DataFrame:
        """Numbers of the partitions that may hold one of the ``rows`` keys from low to high.

        What ``run`` itself added before it died counts besides.
        """
        entries = self.spark.table(self.name).where(F.col(self.key).between(low, high))
        if rows <= POINT_KEYS and isinstance(keys.schema[0].dataType, IntegralType):
            found = entries.where(F.col(self.key).isin([r[0] for r in keys.collect()]))
        else:
            found = entries.join(keys, self.key, "left_semi")
        own = F.col("run") == run
        settled = self._last(found.where(~own)).select("number")
        return settled.union(found.where(own).select("number")).distinct()

    def _last(self, entries: DataFrame) -> DataFrame:
        newest = F.max("generation").over(Window.partitionBy(self.key))
        return entries.withColumn("newest", newest).where("generation = newest").drop("newest")

    def _entries(self, entries: DataFrame, generation: int, run: str) -> DataFrame:
        return entries.select(
            self.key, "number", F.lit(generation).cast("bigint").alias("generation"), F.lit(run).alias("run")
        )

    def _write(self, entries: DataFrame, name: str, buckets: int, mode: str) -> None:
        dealt = entries.repartition(buckets, self.key)
        dealt.write.mode(mode).format("parquet").bucketBy(buckets, self.key).sortBy(self.key).saveAsTable(name)

    def _property(self, name: str) -> int:
        return int(self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('{name}')").first()["value"])
