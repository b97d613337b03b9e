"""Connected components of a links table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored_with


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for linked nodes that are no root.

    ``links`` has two long columns a and b. Each round is two aggregations and joins;
    the links are stored between rounds, each from its greater node u to its lesser one v. Rounds
    grow with the logarithm of the longest chain, and are two or three for star-like groups of copies.
    """
    edges, before = _kept(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while True:
        # A node's greater neighbours go to its least lesser one, or to itself if it has none.
        least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        large = edges.join(least, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        # Then its lesser ones go to the least of them, and so does the node.
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("w"))
        small = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u != v")
        edges, now = _kept(small.distinct(), "stars")
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _kept(edges: DataFrame, purpose: str) -> tuple[DataFrame, list]:
    """The stored edges and a digest of them."""
    return stored_with(edges, purpose, F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(v as decimal(20,0)))"))
