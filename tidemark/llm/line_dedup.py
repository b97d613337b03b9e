"""Line dedup against levelled sorted runs of line hashes.

A run is a table of (line hash, first document) bucketed and sorted by the hash, so
a batch meets it in a merge join that does not move the run. A batch of documents
is anti-joined with all runs, and what is new becomes a run of its own. When a
level has ``fanout`` runs they are merged into one run of the next level, so there
are few runs however many batches came. A hash is in one run only and its first
document never changes, as batches come in the order of their ids.

The first document of a hash is found by an aggregation that combines before it
shuffles; a line that is everywhere reaches the shuffle as one row per task. Only
hashes that are in more than one document are joined with lines again.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, ascii_lower, scratch, stored

NO_ID = 2**63 - 1
HASH = ["h1", "h2"]


def trimmed(line: Column) -> Column:
    """The line without spaces at its ends.

    ``btrim`` makes a table of all characters of the line, so only lines that begin or
    end with a space go there.
    """
    ends = [at_end(line, F.lit(space)) for space in SPACES for at_end in (F.startswith, F.endswith)]
    return F.when(reduce(or_, ends), F.btrim(line, F.lit(SPACES))).otherwise(line)


def line_key(line: Column) -> Column:
    """The line without spaces at its ends, A-Z lower-cased."""
    return ascii_lower(trimmed(line))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """The levelled runs; ``dedup`` takes one batch after the other."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 4, least: int = 10):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.least = least
        self.levels: list[list[str]] = []

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per document of the batch: its columns, n_lines, n_dropped and kept_text.

        A line is dropped if its key has at least ``least`` code points and a document
        with a smaller id has a line with that key. Ids must not be smaller than those
        of earlier batches.

        A null or empty text is one empty line. A null id counts as one document
        after all others. Rows that repeat an id are one document: a line is not
        dropped for another row of its own document. Columns of the batch are kept, but
        the three new ones replace columns of their names.
        """
        # Stored, as both the runs and the drops read them: texts are split and hashed once.
        lines = stored(self._lines(docs, id_col, text_col), "line-hashes")
        # One row per key and batch: its first document here, and whether there is another.
        met = stored(
            lines.groupBy(*HASH).agg(F.min("id").alias("first"), (F.min("id") < F.max("id")).alias("shared")), "line-keys"
        )
        known = self._runs()
        if known is None:
            shared, fresh = met.where("shared").select(*HASH, "first"), met
        else:
            old = known.hint("merge").join(met.select(*HASH), HASH)
            shared = old.union(met.where("shared").select(*HASH, "first").join(known.hint("merge"), HASH, "left_anti"))
            fresh = met.join(known.hint("merge"), HASH, "left_anti")
        shared = stored(shared, "line-shared")
        self._add(fresh.select(*HASH, "first"))

        drops = (
            lines.join(shared, HASH)
            .where("id > first")
            .groupBy("id", "text_hash")
            .agg(F.collect_set("at").alias("__dropped"))
            .select(F.col("id").alias("__drop_id"), F.col("text_hash").alias("__drop_hash"), "__dropped")
        )
        return (
            docs.join(drops, (_id(id_col) == F.col("__drop_id")) & (F.xxhash64(F.col(text_col)) == F.col("__drop_hash")), "left")
            .select(
                *[F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")],
                F.size(lines_of(F.col(text_col))).cast("long").alias("n_lines"),
                F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                F.when(F.col("__dropped").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(_without(F.col(text_col), F.col("__dropped"))).alias("kept_text"),
            )
        )

    def _lines(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        rows = docs.select(
            _id(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
            F.posexplode(lines_of(F.col(text_col))).alias("at", "line"),
        )
        key = line_key(F.col("line"))  # as long as the trimmed line
        long_enough = rows.where(F.char_length(trimmed(F.col("line"))) >= self.least)
        return long_enough.select("id", "text_hash", "at", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))

    def _runs(self) -> DataFrame | None:
        runs = None
        for name in [name for level in self.levels for name in level]:
            run = self.spark.table(name)
            runs = run if runs is None else runs.union(run)
        return runs

    def _add(self, keys: DataFrame, level: int = 0) -> None:
        """Write a run; merge a level's runs into the next level when there are enough."""
        name = f"line_run_{level}_{uuid.uuid4().hex}"
        (
            keys.repartition(self.buckets, "h1")
            .write.bucketBy(self.buckets, "h1").sortBy("h1")
            .option("path", scratch(self.spark, "line-run")).saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level]
            self.levels[level] = []
            together = self.spark.table(merged[0])
            for other in merged[1:]:
                together = together.union(self.spark.table(other))
            self._add(together, level + 1)


def _id(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(NO_ID))


def _without(text: Column, dropped: Column) -> Column:
    """The lines of the text but those at the dropped places, joined.

    The lines are bound by an outer ``transform``: the inner one takes them by place,
    and would split the text anew for every line if they stood in it.
    """

    def kept(lines: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(at, lambda i: F.get(lines, i)), "\n")

    return F.get(F.transform(F.array(lines_of(text)), kept), F.lit(0))


def dedup_lines(
    docs: DataFrame, batches: int = 4, id_col: str = "doc_id", text_col: str = "text", fanout: int = 4, least: int = 10
) -> DataFrame:
    """All documents, taken in ``batches`` of about equal size in the order of their ids."""
    quantiles = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(_id(id_col), quantiles, 1000)).first()[0] if quantiles else None
    bounds = sorted(set(found or []))
    runs = LineRuns(docs.sparkSession, fanout=fanout, least=least)
    result = None
    for low, high in zip([None, *bounds], [*bounds, None]):
        batch = docs
        if low is not None:
            batch = batch.where(F.col(id_col).isNull() | (F.col(id_col) > low) if high is None else F.col(id_col) > low)
        if high is not None:
            batch = batch.where(F.col(id_col) <= high)
        done = runs.dedup(batch, id_col, text_col)
        result = done if result is None else result.unionByName(done)
    return result
