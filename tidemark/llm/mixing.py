"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order, gone through once per
epoch. A document finishes at a virtual time: the words of its queue up to and with
it, divided by the queue's target. Taking documents in order of finish time serves
every source in proportion to its target; the order is cut where the total budget
is reached.

No queue is ever sorted in one task. Running sums are made in two levels: sums per
range of the shuffle order (or of finish time), a running sum over these ranges,
and sorts within a range only. Finish times are evenly filled by construction, so
equal ranges of them hold about equal numbers of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored

BROADCAST_SOURCES = 100_000
ROWS_PER_RANGE = 100_000
LEAST_RANGES = 1024


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _before(sums: DataFrame, order: str, *queue: str) -> DataFrame:
    """The sum of all earlier ranges for each range."""
    earlier = Window.partitionBy(*queue).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2
) -> DataFrame:
    """One row per source: its rank by code point (null last), size and target words.

    The targets share ``share`` times all words by the weights, given in turn to the
    ranked sources. None is above ``epochs`` times its source's size; the excess goes
    to the others by weight. Expects far fewer sources than documents: they are
    ranked in one task, a small row each.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "rank", F.row_number().over(by_name)
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    weighed = named.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(epochs))
    # Sources fill up in the order of what they can give per weight.
    full_at = F.col("most") / F.col("weight")
    filling = Window.orderBy(full_at, "rank")
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(
        F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    level = left / F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighed.withColumn("level", level).withColumn(
        "settled", F.max(F.when(F.col("level") < full_at, F.col("level"))).over(everything)
    )
    target = F.coalesce(F.least("most", F.col("settled") * F.col("weight")), F.col("most"))
    return levels.select("source", "rank", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken words, and text_hash.

    ``taken`` is the size times the epochs in which the document is taken, 0 to
    ``epochs``. The order depends on the seed and the ids only, so reruns agree.

    Null texts and texts without words have size 0 and take nothing; a null source
    is a source of its own, the last. Null ids are shuffled as one place. Repeated
    rows are documents of their own. No documents give no rows. Other columns are
    ignored, whatever their names.
    """
    place = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sized = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"), place.alias("place"), F.xxhash64(F.col(text_col)).alias("text_hash"),
        ),
        "mix-sizes",
    )
    sources = stored(source_targets(sized, weights, share, epochs), "mix-sources")
    facts = sources.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    small = F.broadcast if facts[0] <= BROADCAST_SOURCES else (lambda df: df)
    budget = facts[1]

    queued = sized.withColumnRenamed("source", "from").join(
        small(sources), F.col("from").eqNullSafe(F.col("source"))
    ).drop("from").withColumn("slice", F.substring("place", 1, 3))
    starts = _before(queued.groupBy("rank", "slice").agg(F.sum("size").alias("words")), "slice", "rank")
    order = Window.partitionBy("rank", "slice").orderBy("place", "id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(
        queued.join(starts.select("rank", "slice", "before"), ["rank", "slice"]).withColumn(
            "position", F.col("before") + F.sum("size").over(order)
        ).select("id", "source", "size", "source_size", "target", "rank", "position", "text_hash"),
        "mix-queues",
    )

    turns = placed.where("size > 0 AND target > 0").select(
        "rank", "size", "target",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: e * F.col("source_size") + F.col("position"))).alias("position"),
    ).withColumn("finish", F.col("position") / F.col("target"))
    ranges = max(LEAST_RANGES, sized.count() // ROWS_PER_RANGE)
    turns = turns.withColumn("range", F.floor(F.col("finish") * ranges))
    sums = _before(turns.groupBy("range").agg(F.sum("size").alias("words")), "range")
    crossing = sums.where((F.col("before") <= budget) & (F.col("before") + F.col("words") > budget)).select("range", "before").first()
    if crossing is None:
        times = F.lit(epochs)
    else:
        # All earlier ranges are taken and all later ones are not; only this one is sorted.
        inside = Window.partitionBy("range").orderBy("finish", "rank", "position").rowsBetween(Window.unboundedPreceding, 0)
        cut = (
            turns.where(F.col("range") == crossing["range"])
            .withColumn("total", F.sum("size").over(inside) + crossing["before"])
            .where(F.col("total") > budget)
            .agg(F.min(F.struct("finish", "rank", "position")).alias("cut"))
            .first()["cut"]
        )
        limit = F.struct(F.lit(cut["finish"]), F.lit(cut["rank"]), F.lit(cut["position"]).cast("long"))
        times = sum(
            (
                F.struct((F.col("position") + e * F.col("source_size")) / F.col("target"), F.col("rank"), F.col("position") + e * F.col("source_size"))
                < limit
            ).cast("int")
            for e in range(epochs)
        )
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * times).otherwise(F.lit(0)).cast("long")
    return placed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", taken.alias("taken"), "text_hash"
    )
