"""Near copies among vectors, by an exact metric range join.

Vectors of equal direction lie on a sphere, where a cosine of ``least`` is a distance
``r``. Pivots partition the vectors: each lives in the cell of its nearest pivot. A
pair within ``r`` either shares its home, or one of the two is sent into the other's
cell as a visitor, into the cell of the later pivot. The triangle inequality says who
must be sent: only a vector at most ``2 * r`` farther from the other pivot than from
its own (on a sphere, not farther than ``r`` from the plane between the two), and not
farther than ``r`` beyond the cell's own vectors. Cells then join independently: each
is cut into rings of width ``r`` around its pivot, and vectors of a pair lie in the same
ring or in neighbouring ones.

Equal vectors are one row with a weight. Pivots keep a distance from each other, so a
large group of near copies has one home; its rings are cut into blocks by hash, and
two blocks are compared at a time, in a task of their own. Such a comparison returns
the links that each vector has in it and one vector of its group, not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.components import components

BLOCK_ROWS = 2048
STRIPE_ROWS = 256
ROWS_PER_PIVOT = 2048
MOST_PIVOTS = 1024
BROADCAST_ROWS = 1_000_000
# Beyond what rounding changes in a distance of unit vectors.
SLACK = 1e-6


@dataclass(frozen=True)
class Cells:
    """Pivots as unit rows, the reach of a link, and each cell's span of distances."""

    pivots: np.ndarray
    reach: float
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def distances(self, units: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2.0 - 2.0 * (units @ self.pivots.T), 0.0))

    def ring(self, distance: np.ndarray) -> np.ndarray:
        return np.floor(distance / (self.reach * (1 + 1e-6) + SLACK)).astype(np.int32)

    def visits(self, home: np.ndarray, away: np.ndarray) -> np.ndarray:
        """Which vectors (rows) may have a link to a vector of which later cell (columns)."""
        own = away[np.arange(len(away)), home][:, None]
        between = self.distances(self.pivots)[home]
        # The distance to the plane between two pivots; equal pivots have none.
        plane = (away**2 - own**2) / np.maximum(2.0 * between, 1e-12)
        near = (plane <= self.reach + SLACK) & (away <= own + 2 * self.reach + SLACK)
        near &= (away <= self.high + self.reach + SLACK) & (away >= self.low - self.reach - SLACK)
        return near & (np.arange(len(self.pivots))[None, :] > home[:, None])


def spread_pivots(sample: np.ndarray, most: int, apart: float) -> np.ndarray:
    """Rows of the sample in order, each at least ``apart`` from those before it."""
    chosen = np.zeros((0, sample.shape[1]))
    for row in sample:
        if len(chosen) == most:
            break
        if not len(chosen) or np.sqrt(max(0.0, 2.0 - 2.0 * float((chosen @ row).max()))) >= apart:
            chosen = np.vstack((chosen, row))
    return chosen


def matrix(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros; each is scaled by a power of two, which changes no cosine."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    _, exponent = np.frexp(np.abs(out).max(axis=1, initial=0.0))
    return np.ldexp(out, -exponent[:, None])


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=1))


def linked(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which rows of two blocks have a cosine of ``least`` or more."""
    out = np.empty((len(left), len(right)), dtype=bool)
    right_norms = _norms(right)
    for at in range(0, len(left), STRIPE_ROWS):
        part = left[at : at + STRIPE_ROWS]
        out[at : at + STRIPE_ROWS] = (part @ right.T) / np.outer(_norms(part), right_norms) >= least
    return out


def roots(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a table of links, the first row of their group; as many rounds as the longest chain."""
    label = np.arange(links.shape[0])
    far = links.shape[0]
    while True:
        across = np.full(links.shape[1], far)
        for at in range(0, len(label), STRIPE_ROWS):
            part = links[at : at + STRIPE_ROWS]
            across = np.minimum(across, np.where(part, label[at : at + STRIPE_ROWS, None], far).min(axis=0, initial=far))
        fresh = label.copy()
        for at in range(0, len(label), STRIPE_ROWS):
            part = links[at : at + STRIPE_ROWS]
            fresh[at : at + STRIPE_ROWS] = np.minimum(label[at : at + STRIPE_ROWS], np.where(part, across[None, :], far).min(axis=1, initial=far))
        if (fresh == label).all():
            return label, across
        label = fresh


def compare(same: bool, ids: tuple[np.ndarray, np.ndarray], weights: tuple[np.ndarray, np.ndarray], blocks: tuple[np.ndarray, np.ndarray], least: float) -> pd.DataFrame:
    """vector, its links to rows of the other block, and a vector of its group, for vectors with a link."""
    links = linked(*blocks, least)
    if same:
        np.fill_diagonal(links, False)
    rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    links = links[np.ix_(rows, columns)]
    # Rows that are the columns too tie the two sides of a group together.
    first, across = roots(links | np.eye(len(rows), dtype=bool)) if same else roots(links)
    names = ids[0][rows]
    found = [pd.DataFrame({"vector": names, "links": links @ weights[1][columns], "near": names[first]})]
    if not same:
        found.append(pd.DataFrame({"vector": ids[1][columns], "links": weights[0][rows] @ links, "near": names[across]}))
    return pd.concat(found)


def _usable(vector: Column) -> Column:
    """Finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _keys(label: Column, vector: Column) -> list[Column]:
    """A label and a vector as two 64-bit hashes."""
    return [F.xxhash64(label, vector).alias("k1"), F.xxhash64(F.lit(1), vector, label).alias("k2")]


def near_vectors(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id and kept, for each row.

    Rows with equal labels link when the cosine of their vectors, in double precision,
    is ``least`` (above 0) or more. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links, and a row is kept when that
    is its own id.

    Rows with a null label, a null, empty or zero vector, or a null or non-finite
    component link with nothing. Shorter vectors are filled with zeros. Equal vectors
    of one label link, also under one id: every row is a row of its own. A null id is
    never the smallest; a row with a null id is not kept, and where its group has no
    other id, component_id is null. No rows give no rows. Other columns are ignored,
    whatever their names.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v")
    )
    usable = F.coalesce(F.col("label").isNotNull() & _usable(F.col("v")), F.lit(False))
    classes = stored(
        rows.where(usable).groupBy("label", "v").agg(F.count("*").alias("weight"), F.min("id").alias("first"))
        .select(F.monotonically_increasing_id().alias("vector"), "label", "v", "weight", "first", *_keys(F.col("label"), F.col("v"))),
        "metric-classes",
    )
    found = _found(classes, least)
    degrees = found.groupBy("vector").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("vector").alias("a"), F.col("near").alias("b")))
    rooted = (
        classes.select("vector", "weight", "first", "k1", "k2")
        .join(degrees, "vector", "left").join(joined.withColumnRenamed("node", "vector"), "vector", "left")
        .select("k1", "k2", "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "vector").alias("root"))
    )
    least_ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(least_ids, "root").select("k1", "k2", "n_links", "component_id"), "metric-named")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    result = rows.where(usable).select("id", *_keys(F.col("label"), F.col("v"))).join(named, ["k1", "k2"]).select("id", "n_links", "component_id")
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return result.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", kept)


def _found(classes: DataFrame, least: float) -> DataFrame:
    """vector, links and near of all compared blocks."""
    spark = classes.sparkSession
    n, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * least))
    most = min(MOST_PIVOTS, -(-n // ROWS_PER_PIVOT))
    sample = matrix([r["v"] for r in classes.orderBy(F.xxhash64("k1"), "k2").select("v").limit(4 * most).collect()], width)
    bare = Cells(spread_pivots(sample / np.maximum(_norms(sample), 1e-300)[:, None], most, 3 * reach), reach)

    def units(batch: pd.DataFrame) -> np.ndarray:
        m = matrix(batch["v"].tolist(), width)
        return m / _norms(m)[:, None]

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            away = bare.distances(units(batch))
            home = away.argmin(axis=1)
            yield batch.assign(home=home, away=away[np.arange(len(batch)), home])

    homes = stored(
        classes.select("vector", "label", "v", "weight").mapInPandas(settle, "vector long, label string, v array<double>, weight long, home int, away double"),
        "metric-homes",
    )
    span = {r["home"]: (r["low"], r["high"]) for r in homes.groupBy("home").agg(F.min("away").alias("low"), F.max("away").alias("high")).collect()}
    # A cell without vectors is never visited.
    low, high = (np.array([span.get(p, (np.inf, -np.inf))[k] for p in range(len(bare.pivots))]) for k in (0, 1))
    cells = Cells(bare.pivots, reach, low, high)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            data = [x.tobytes() for x in matrix(batch["v"].tolist(), width)]
            away, home = cells.distances(units(batch)), batch["home"].to_numpy()
            row, cell = np.nonzero(cells.visits(home, away))
            row, cell = np.append(np.arange(len(batch)), row), np.append(home, cell)
            yield pd.DataFrame(
                {
                    "vector": batch["vector"].to_numpy()[row], "label": batch["label"].array.take(row), "weight": batch["weight"].to_numpy()[row],
                    "cell": cell.astype(np.int32), "ring": cells.ring(away[row, cell]), "visitor": np.arange(len(row)) >= len(batch),
                    "v": [data[i] for i in row],
                }
            )

    keys = ["label", "cell", "ring", "visitor"]
    placed = stored(
        homes.mapInPandas(place, "vector long, label string, weight long, cell int, ring int, visitor boolean, v binary"), "metric-placed"
    )
    sizes = stored(placed.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("cuts")), "metric-sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                **{k: [group[k].iloc[0]] for k in keys},
                "ids": [group["vector"].to_numpy(np.int64).tobytes()], "weights": [group["weight"].to_numpy(np.int64).tobytes()], "data": [b"".join(group["v"])],
            }
        )

    cut = placed.join(sizes, keys).withColumn("cut", F.pmod(F.xxhash64("vector"), F.col("cuts")))
    packed = cut.groupBy(*keys, "cut").applyInPandas(
        pack, "label string, cell int, ring int, visitor boolean, ids binary, weights binary, data binary"
    )
    blocks = stored(packed.select(F.monotonically_increasing_id().alias("block"), "*"), "metric-blocks")

    names = blocks.select("block", *keys)
    residents = names.where("not visitor").select(F.col("block").alias("a"), "label", "cell", "ring")
    others = names.select(F.col("block").alias("b"), "label", "cell", F.explode(F.array(F.col("ring") - 1, "ring", F.col("ring") + 1)).alias("ring"), "visitor")
    pairs = residents.join(others, ["label", "cell", "ring"]).where("visitor or a <= b").select("a", "b")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.ids_a, np.int64), np.frombuffer(r.ids_b, np.int64)
                weights = np.frombuffer(r.weights_a, np.int64), np.frombuffer(r.weights_b, np.int64)
                data = tuple(np.frombuffer(x, np.float64).reshape(len(i), -1) for x, i in zip((r.data_a, r.data_b), ids))
                yield compare(r.a == r.b, ids, weights, data, least)

    sides = {s: blocks.select(F.col("block").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "weights", "data"))) for s in "ab"}
    met = stored(pairs, "metric-pairs").join(sides["a"], "a").join(sides["b"], "b")
    few = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}
    return stored(met.mapInPandas(meet, "vector long, links long, near long"), "metric-links", few)
