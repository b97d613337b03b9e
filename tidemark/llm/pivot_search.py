"""Exact top-k by inner product with a pivot-distance index.

One more coordinate makes all indexed vectors equally long, so the largest inner
product is the smallest distance. Each vector is filed under its nearest pivot and
its distance to it; equal steps of distance are rings around the pivot. By the
triangle inequality a ring whose distances differ from the query's by more than r
holds nothing within r.

A search first reads the rings its queries lie in, which gives each query a k-th best
score, and then only the rings that can hold a better one. Rings are cut into blocks
by the hash of the id, so a vector that a third of all rows have fills many blocks
and no task. Queries go in tiles; a tile meets a block in one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

RINGS = 64
BLOCK_ROWS = 2048
TILE_ROWS = 256
EXACT = 2.0**53


@dataclass(frozen=True)
class Index:
    """Pivots (a bounded sample), and the length all vectors are brought to."""

    pivots: np.ndarray
    length: float
    width: int

    def matrix(self, vectors: list) -> np.ndarray:
        """Integer vectors as rows, shorter ones filled with zeros."""
        out = np.zeros((len(vectors), self.width), dtype=np.int64)
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def _added(self, m: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.length**2 - (m.astype(float) ** 2).sum(axis=1), 0.0))

    def distances(self, m: np.ndarray) -> np.ndarray:
        """From indexed vectors to all pivots, in the space with one coordinate more."""
        products = m.astype(float) @ self.pivots.T.astype(float) + np.outer(self._added(m), self._added(self.pivots))
        return np.sqrt(np.maximum(2 * self.length**2 - 2 * products, 0.0))

    def query_distances(self, m: np.ndarray) -> np.ndarray:
        """From queries, whose added coordinate is zero, to all pivots."""
        norms = (m.astype(float) ** 2).sum(axis=1, keepdims=True)
        return np.sqrt(np.maximum(norms + self.length**2 - 2 * (m.astype(float) @ self.pivots.T.astype(float)), 0.0))

    @property
    def step(self) -> float:
        return max(2 * self.length / RINGS, 1e-9)

    def bound(self, m: np.ndarray, away: np.ndarray, ring: int) -> np.ndarray:
        """No vector of a ring has a larger product with each query; ``away`` is to its pivot."""
        slack = 1e-7 * (1.0 + self.length)
        gap = np.maximum(np.maximum(ring * self.step - away, away - (ring + 1) * self.step) - slack, 0.0)
        norms = (m.astype(float) ** 2).sum(axis=1)
        total = norms + self.length**2
        return (total - gap**2) / 2 + 1e-9 * total + 1e-3


def products(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point only where that is exact."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * queries.shape[1]
    if top < EXACT:
        return (queries.astype(float) @ block.T.astype(float)).astype(np.int64)
    return queries @ block.T


def best_of_block(
    query_rows: np.ndarray, queries: np.ndarray, in_block: np.ndarray, ids: np.ndarray, block: np.ndarray, k: int, least: np.ndarray
) -> pd.DataFrame:
    """The k best of the block for each query, from its least useful score on; ids ascend, ``in_block`` are their rows."""
    scores = products(queries, block)
    own = query_rows[:, None] == in_block[None, :]
    rows, columns, values = [], [], []
    for q in range(len(query_rows)):
        useful = np.flatnonzero((scores[q] >= least[q]) & ~own[q])
        if len(useful) > k:
            useful = useful[np.argsort(-scores[q, useful], kind="stable")[:k]]
        rows.append(np.full(len(useful), query_rows[q]))
        columns.append(ids[useful])
        values.append(scores[q, useful])
    return pd.DataFrame({"query": np.concatenate(rows), "vec_id": np.concatenate(columns), "score": np.concatenate(values)})


def _int64(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64)


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: float = 256.0) -> DataFrame:
    """id and integer vector of usable rows."""
    v = F.col(vec_col)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & usable)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def top_k_products(
    vectors: DataFrame, k: int = 5, every: int = 50, pivots: int = 16, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but
    the query's own. The score is the integer inner product of ``floor(256 * x)``;
    ties go to the smaller id. The pivots are the ``pivots`` rows of least id hash,
    and they only steer the order of the search: the result is exact.

    Rows with a null id, a null vector, or a null or non-finite component take no
    part. Rows of a repeated id are rows of their own, as queries and as candidates of
    each other. Shorter vectors are filled with zeros, an empty one is all zeros. With fewer than k candidates all are
    returned; without rows nothing is. Other columns are ignored, whatever their
    names. Products are expected to fit 63 bits.
    """
    spark = vectors.sparkSession
    rows = stored(quantized(vectors, id_col, vec_col).select(F.monotonically_increasing_id().alias("row"), "*"), "pivot-vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norm, width, n_queries = rows.agg(
        F.coalesce(F.max(squares), F.lit(0.0)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if(F.pmod("id", F.lit(every)) == 0)
    ).first()
    chosen = rows.orderBy(F.xxhash64("id"), "id", "row").limit(pivots).collect()
    kind = "query long, vec_id long, score long"
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bare = Index(np.zeros((0, width), np.int64), float(np.sqrt(norm)), max(1, width))
    index = Index(bare.matrix([r["v"] for r in chosen]), bare.length, bare.width)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = index.matrix(batch["v"].tolist())
            away = index.distances(m)
            near = away.argmin(axis=1)
            ring = np.floor(away[np.arange(len(m)), near] / index.step).astype(np.int32)
            yield pd.DataFrame({"row": batch["row"], "id": batch["id"], "pivot": near.astype(np.int32), "ring": ring, "v": [x.tobytes() for x in m]})

    filed = stored(rows.mapInPandas(file, "row long, id long, pivot int, ring int, v binary"), "pivot-filed")
    # At most pivots * RINGS rows.
    sizes = filed.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("cuts"))
    rings = sorted((r["pivot"], r["ring"]) for r in sizes.collect())

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "row"])
        keys = group[["pivot", "ring"]].iloc[0]
        own = {c: [group[c].to_numpy(np.int64).tobytes()] for c in ("row", "id")}
        return pd.DataFrame(
            {"pivot": [keys["pivot"]], "ring": [keys["ring"]], "rows": own["row"], "ids": own["id"], "block": [b"".join(group["v"])]}
        )

    cut = filed.join(F.broadcast(sizes), ["pivot", "ring"]).withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")))
    blocks = stored(
        cut.groupBy("pivot", "ring", "cut").applyInPandas(pack, "pivot int, ring int, rows binary, ids binary, block binary"), "pivot-blocks"
    )

    tiles_per_pivot = max(1, -(-int(n_queries) // (TILE_ROWS * pivots)))

    def tile(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        return pd.DataFrame(
            {
                "tile": [f"{group['pivot'].iloc[0]}-{group['part'].iloc[0]}"], "home": [int(group["pivot"].iloc[0])],
                "rings": [sorted(set(group["ring"].tolist()))], "query_rows": [group["row"].to_numpy(np.int64).tobytes()], "queries": [b"".join(group["v"])],
            }
        )

    queries = filed.where(F.pmod("id", F.lit(every)) == 0).withColumn("part", F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(tiles_per_pivot)))
    tiles = stored(
        queries.groupBy("pivot", "part").applyInPandas(tile, "tile string, home int, rings array<int>, query_rows binary, queries binary"), "pivot-tiles"
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                query_rows, ids = _int64(r.query_rows), _int64(r.ids)
                least = _int64(r.least) if r.least is not None else np.full(len(query_rows), np.iinfo(np.int64).min)
                yield best_of_block(
                    query_rows, _int64(r.queries).reshape(len(query_rows), -1), _int64(r.rows), ids, _int64(r.block).reshape(len(ids), -1), k, least
                )

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    home = tiles.select("query_rows", "queries", F.lit(None).cast("binary").alias("least"), F.col("home").alias("pivot"), F.explode("rings").alias("ring"))
    near = stored(ranked(home.join(blocks, ["pivot", "ring"]).select("query_rows", "queries", "least", "rows", "ids", "block").mapInPandas(search, kind)), "pivot-near")

    kth = near.where(F.col("rank") == k).select("query", "score")
    tile_of = queries.select(F.concat_ws("-", "pivot", "part").alias("tile"), F.col("row").alias("query"))
    limits = tile_of.join(kth, "query", "left").groupBy("tile").agg(F.collect_list(F.struct("query", "score")).alias("limits"))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                query_rows = _int64(r.query_rows)
                m = _int64(r.queries).reshape(len(query_rows), -1)
                known = {x["query"]: x["score"] for x in r.limits if x["score"] is not None}
                least = np.array([known.get(q, np.iinfo(np.int64).min) for q in query_rows.tolist()], dtype=np.int64)
                away = index.query_distances(m)
                done = {(r.home, x) for x in r.rings}
                wanted = [
                    (pivot, ring) for pivot, ring in rings
                    if (pivot, ring) not in done and (index.bound(m, away[:, pivot], ring) >= least).any()
                ]
                yield pd.DataFrame(
                    {
                        "pivot": np.array([p for p, _ in wanted], np.int32), "ring": np.array([x for _, x in wanted], np.int32),
                        "query_rows": [r.query_rows] * len(wanted), "queries": [r.queries] * len(wanted), "least": [least.tobytes()] * len(wanted),
                    }
                )

    asked = tiles.join(limits, "tile").mapInPandas(expand, "pivot int, ring int, query_rows binary, queries binary, least binary")
    far = asked.join(blocks, ["pivot", "ring"]).select("query_rows", "queries", "least", "rows", "ids", "block").mapInPandas(search, kind)
    found = ranked(near.select("query", "vec_id", "score").union(far))
    return found.join(queries.select(F.col("row").alias("query"), F.col("id").alias("query_id")), "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
