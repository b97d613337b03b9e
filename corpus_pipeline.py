"""From raw documents to a training mix, in five stages.

Each stage takes the documents its predecessor kept and returns documents; the last
returns one row for each time a document is taken, with its epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import small_batches, stored, stored_with, table
from tidemark.llm.decontamination import find_leaks
from tidemark.llm.jaccard import near_duplicates
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.toxicity import toxicity

BROADCAST_KEYS = 1_000_000
# Not SQL: a learned classifier, similarity components and alignments.
ORACLE_SQL = None


def _key() -> list[Column]:
    """What tells documents apart where ids repeat or are null."""
    return [F.coalesce("doc_id", F.lit(-1)).alias("__k1"), F.col("doc_id").isNull().alias("__k2"), F.xxhash64("text").alias("__k3")]


def _keys_of(found: DataFrame) -> DataFrame:
    keys, (rows,) = stored_with(
        found.select(F.coalesce("doc_id", F.lit(-1)).alias("__k1"), F.col("doc_id").isNull().alias("__k2"), F.col("text_hash").alias("__k3")).distinct(),
        "pipeline-keys", F.count("*"),
    )
    return F.broadcast(keys) if rows <= BROADCAST_KEYS else keys


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("*", *_key())


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by labels learned from this stage's documents."""
    small_batches(spark)
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one has; n_chars follows the text."""
    done = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumns({"text": text, "n_chars": n_chars}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, then text hash; one of equal rows.

    A null id comes after all others. Documents without words are in no group.
    """
    found = near_duplicates(docs)
    alone = found.where("component IS NULL").groupBy("doc_id", "text_hash").agg(F.count("*").alias("__times"))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    groups = found.where("component IS NOT NULL").groupBy("component", row.alias("row")).agg(F.count("*").alias("n"))
    first = groups.groupBy("component").agg(F.min(F.struct("row", "n")).alias("first"))
    kept = first.select("first.row.doc_id", "first.row.text_hash", F.col("first.n").alias("__times")).union(alone)
    kept = stored(kept, "pipeline-kept")
    names = ["__k1", "__k2", "__k3"]
    once = _keyed(docs).join(_keys_of(kept.where("__times = 1")), names, "left_semi")
    repeated = kept.where("__times > 1")
    if repeated.isEmpty():
        return once.select(*docs.columns)
    more = _keyed(docs).join(_keys_of(repeated), names, "left_semi").dropDuplicates(names)
    return once.union(more).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    small_batches(spark)
    leaks = _keys_of(find_leaks(docs, table(spark, sf_dir, "benchmark")))
    return _keyed(docs).join(leaks, ["__k1", "__k2", "__k3"], "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for each epoch that takes it, with the epoch from 0."""
    names = ["__k1", "__k2", "__k3", "__k4", "__k5"]
    source = [F.coalesce("source", F.lit("")).alias("__k4"), F.col("source").isNull().alias("__k5")]
    picks = stored(
        mix(docs).where("taken > 0").select(
            F.coalesce("doc_id", F.lit(-1)).alias("__k1"), F.col("doc_id").isNull().alias("__k2"), F.col("text_hash").alias("__k3"), *source,
            (F.col("taken") / F.col("size")).cast("int").alias("__times"),
        ),
        "pipeline-picks",
    )
    counts = picks.groupBy(*names).agg(F.count("*").alias("rows"), F.first("__times").alias("__times"))
    keyed = docs.select("*", *_key(), *source)
    taken = keyed.join(counts.where("rows = 1").select(*names, "__times"), names)
    several = stored(counts.where("rows > 1").select(*names), "pipeline-several")
    if not several.isEmpty():
        # Equal rows are told apart by a number on either side.
        nth = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1)))
        left = keyed.join(several, names, "left_semi").withColumn("__nth", nth)
        right = picks.join(several, names, "left_semi").withColumn("__nth", nth)
        taken = taken.unionByName(left.join(right, [*names, "__nth"]).drop("__nth"))
    epochs = F.explode(F.sequence(F.lit(0), F.col("__times") - 1)).alias("epoch")
    return taken.select(*docs.columns, epochs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-stage-{number}")
    return docs
