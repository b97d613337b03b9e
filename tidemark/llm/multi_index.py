"""Hard negatives from an inverted multi-index.

Vectors are cut in two halves, and each half has a codebook, learned from a bounded
sample. A pair of codes is a cell; every row is filed in the cell of its two nearest
codes. With a code's radius, the distance of its farthest half over all rows, an
anchor's half-score with any row of the code lies within ``anchor . code`` plus or minus
``|anchor| * radius``. Cells are visited by the sum of the two upper bounds, from a
heap over both codebooks in sorted order: the multi-sequence walk.

An anchor asks for the k best rows within windows of scores. A window is certified
when its k-th best score, or else its lower end, is above the bound of the next
cell; cells whose scores all lie above every window are passed over. Anchors walk in
rounds, each eight times as far as the last. In a round the cells asked for meet the
anchors asking in tiles, and only rows that can still be among the k best come back.

First the positives are searched, in one window without ends, then the negatives in
the windows that the positives' scores give.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.pivot_search import products

BLOCK_ROWS = 2048
TILE_ROWS = 256
CODES = (4, 256)
SAMPLE_ROWS = 4096
FIRST_CELLS = 4
GROWTH = 8
LEARNING_ROUNDS = 8
LOWEST, HIGHEST = -(2**62), 2**62
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}


def learn_codes(halves: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` centres of the rows by a few rounds of k-means, from the first different rows."""
    codes = np.unique(halves, axis=0)
    codes = codes[np.linspace(0, len(codes) - 1, min(n, len(codes))).astype(int)].astype(float)
    for _ in range(LEARNING_ROUNDS):
        nearest = _away(halves, codes).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(codes))
        total = np.zeros_like(codes)
        np.add.at(total, nearest, halves)
        codes[count > 0] = total[count > 0] / count[count > 0, None]
    return codes


def _away(halves: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codes."""
    return np.maximum((halves**2).sum(axis=1)[:, None] + (codes**2).sum(axis=1) - 2 * halves @ codes.T, 0.0)


def walk(first: np.ndarray, second: np.ndarray, filled: set[tuple[int, int]]) -> Iterator[tuple[float, int, int]]:
    """Filled cells by falling sum of their two bounds, with the sum."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)] if len(a) and len(b) else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if (int(a[i]), int(b[j])) in filled:
            yield -bound, int(a[i]), int(b[j])


@dataclass(frozen=True)
class MultiIndex:
    """Two codebooks, their radii over all rows, and the cells that have rows."""

    codes: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None
    filled: frozenset = frozenset()

    @property
    def half(self) -> int:
        return self.codes[0].shape[1]

    def halves(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return m[:, : self.half].astype(float), m[:, self.half :].astype(float)

    def wanted(self, anchor: np.ndarray, windows: list[tuple[int, int, int]], start: int, stop: int) -> tuple[list[tuple[int, int]], bool]:
        """Cells from the start-th to before the stop-th that a window may need, and whether later ones may be needed.

        A window is its lowest and highest score and the least score that still counts.
        """
        middle = [h[0] @ c.T for h, c in zip(self.halves(anchor[None, :]), self.codes)]
        spread = [np.sqrt((h[0] ** 2).sum()) * r for h, r in zip(self.halves(anchor[None, :]), self.radii)]
        slack = 1.0 + 1e-9 * sum(float(np.abs(m).max(initial=0.0) + s.max(initial=0.0)) for m, s in zip(middle, spread))
        needs = [(max(low, least), high) for low, high, least in windows if max(low, least) <= high]
        floor = min((low for low, _ in needs), default=None)
        out: list[tuple[int, int]] = []
        if floor is None:
            return out, False
        for nth, (bound, i, j) in enumerate(walk(middle[0] + spread[0], middle[1] + spread[1], self.filled)):
            if bound + slack < floor:
                return out, False
            if nth >= stop:
                return out, True
            lower = middle[0][i] - spread[0][i] + middle[1][j] - spread[1][j] - slack
            if nth >= start and any(low <= bound + slack and lower <= high for low, high in needs):
                out.append((i, j))
        return out, False


def matrix(vectors: list, width: int) -> np.ndarray:
    """Integer vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def best_of_block(tile: list, block: dict[str, np.ndarray], k: int, same: bool) -> pd.DataFrame:
    """anchor, window, row, id and score of the k best rows of the block for each window of each anchor.

    Rows of the block come by id. ``same`` asks for rows of the anchor's own label, but
    not the anchor; else for those of others.
    """
    scores = products(np.stack([np.frombuffer(a["q"], np.int64) for a in tile]), block["data"])
    found: list[tuple[int, int, np.ndarray]] = []
    for anchor, score in zip(tile, scores):
        eligible = (block["labels"] == anchor["label"]) == same
        if same:
            eligible &= block["rows"] != anchor["row"]
        for w in anchor["windows"]:
            at = np.flatnonzero(eligible & (score >= max(w["low"], w["least"])) & (score <= w["high"]))
            if len(at) > k:
                at = at[np.argsort(-score[at], kind="stable")[:k]]
            if len(at):
                found.append((anchor["row"], w["window"], np.stack((block["rows"][at], block["ids"][at], score[at]))))
    size = [x.shape[1] for _, _, x in found]
    row, vec, score = np.concatenate([np.zeros((3, 0), np.int64), *(x for _, _, x in found)], axis=1)
    return pd.DataFrame(
        {"anchor": np.repeat([a for a, _, _ in found], size).astype(np.int64), "window": np.repeat([w for _, w, _ in found], size).astype(np.int64), "row": row, "id": vec, "score": score}
    )


def quantized(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: float) -> DataFrame:
    """id, label and integer vector of the rows that take part."""
    v = F.col("v")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & usable)
    return rows.withColumn("v", F.transform(v, lambda x: F.floor(x * scale)))


class _Search:
    """Filed rows in blocks, and the walk of anchors through them."""

    def __init__(self, filed: DataFrame, index: MultiIndex, blocks: DataFrame, anchors: DataFrame, n_anchors: int):
        self.filed, self.index, self.blocks, self.anchors = filed, index, blocks, anchors
        self.parts = -(-max(1, n_anchors) // TILE_ROWS)

    def best(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """anchor, window, rank, id and score of the k best rows for each asked window: anchor, window, low and high."""
        empty = "anchor long, window long, row long, id long, score long, rank int"
        spark = self.filed.sparkSession
        found = spark.createDataFrame([], empty)
        start, stop = 0, FIRST_CELLS
        while start < len(self.index.filled):
            cells = stored(self._cells(asked, found, k, start, stop), "index-asked")
            if cells.isEmpty():
                break
            more = self._scored(cells.where("c1 IS NOT NULL"), k, same)
            ranked = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id", "row")
            both = found.drop("rank").unionByName(more).withColumn("rank", F.row_number().over(ranked))
            found = stored(both.where(F.col("rank") <= k), "index-found")
            start, stop = stop, stop * GROWTH
        return found

    def _cells(self, asked: DataFrame, found: DataFrame, k: int, start: int, stop: int) -> DataFrame:
        """A row for each anchor and cell of this round; c1 is null where only later cells are needed."""
        index = self.index
        kth = found.where(F.col("rank") == k).select("anchor", "window", F.col("score").alias("least"))
        windows = (
            asked.join(kth, ["anchor", "window"], "left").groupBy("anchor")
            .agg(F.collect_list(F.struct("window", "low", "high", F.coalesce("least", F.lit(LOWEST)).alias("least"))).alias("windows"))
        )

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows, first, second = [], [], []
                for i, (q, asks) in enumerate(zip(batch["q"], batch["windows"])):
                    cells, more = index.wanted(np.frombuffer(q, np.int64), [(w["low"], w["high"], w["least"]) for w in asks], start, stop)
                    for cell in cells or [(None, None)] * more:
                        rows.append(i)
                        first.append(cell[0])
                        second.append(cell[1])
                yield batch.iloc[rows].assign(c1=pd.array(first, dtype="Int32"), c2=pd.array(second, dtype="Int32"))

        kind = "anchor long, label long, q binary, windows array<struct<window:long,low:long,high:long,least:long>>, c1 int, c2 int"
        return self.anchors.join(windows, "anchor").select("anchor", "label", "q", "windows").mapInPandas(visit, kind)

    def _scored(self, cells: DataFrame, k: int, same: bool) -> DataFrame:
        tiles = cells.groupBy("c1", "c2", F.pmod(F.xxhash64("anchor"), F.lit(self.parts)).alias("part")).agg(
            F.collect_list(F.struct(F.col("anchor").alias("row"), "label", "q", "windows")).alias("tile")
        )

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples(index=False):
                    rows, ids, labels = (np.frombuffer(x, np.int64) for x in (r.rows, r.ids, r.labels))
                    block = {"rows": rows, "ids": ids, "labels": labels, "data": np.frombuffer(r.data, np.int64).reshape(len(rows), -1)}
                    yield best_of_block(r.tile, block, k, same)

        met = tiles.join(self.blocks, ["c1", "c2"]).select("tile", "rows", "ids", "labels", "data")
        return stored(met.mapInPandas(score, "anchor long, window long, row long, id long, score long"), "index-scored", FEW_ROWS)


def _search(rows: DataFrame, every: int) -> _Search | None:
    """All rows filed by their two nearest codes; none without rows."""
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if not n:
        return None
    width = max(2, width)
    sample = matrix([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id", "row").select("v").limit(SAMPLE_ROWS).collect()], width)
    codes = int(min(CODES[1], max(CODES[0], round((n / BLOCK_ROWS) ** 0.5))))
    half = width // 2
    bare = MultiIndex((learn_codes(sample[:, :half].astype(float), codes), learn_codes(sample[:, half:].astype(float), codes)))

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = matrix(batch["v"].tolist(), width)
            near = [_away(h, c) for h, c in zip(bare.halves(m), bare.codes)]
            c1, c2 = (x.argmin(axis=1).astype(np.int32) for x in near)
            r1, r2 = (np.sqrt(x.min(axis=1)) if len(x) else np.zeros(0) for x in near)
            yield pd.DataFrame({"row": batch["row"], "id": batch["id"], "label": batch["label"], "q": [x.tobytes() for x in m], "c1": c1, "c2": c2, "r1": r1, "r2": r2})

    filed = stored(rows.mapInPandas(file, "row long, id long, label long, q binary, c1 int, c2 int, r1 double, r2 double"), "index-filed")
    # At most a row for each pair of codes.
    cells = filed.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
    radii = tuple(np.zeros(len(c)) for c in bare.codes)
    for r in cells:
        # Slack for the rounding of distances.
        radii[0][r["c1"]] = max(radii[0][r["c1"]], r["r1"] * (1 + 1e-9) + 1e-3)
        radii[1][r["c2"]] = max(radii[1][r["c2"]], r["r2"] * (1 + 1e-9) + 1e-3)
    index = MultiIndex(bare.codes, radii, frozenset((r["c1"], r["c2"]) for r in cells))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "row"])
        own = {k: [group[k].to_numpy(np.int64).tobytes()] for k in ("row", "id", "label")}
        return pd.DataFrame(
            {"c1": [group["c1"].iloc[0]], "c2": [group["c2"].iloc[0]], "rows": own["row"], "ids": own["id"], "labels": own["label"], "data": [b"".join(group["q"])]}
        )

    cuts = filed.sparkSession.createDataFrame([(r["c1"], r["c2"], -(-r["n"] // BLOCK_ROWS)) for r in cells], "c1 int, c2 int, cuts int")
    cut = filed.select("c1", "c2", "row", "id", "label", "q").join(F.broadcast(cuts), ["c1", "c2"]).withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")))
    blocks = stored(
        cut.groupBy("c1", "c2", "cut").applyInPandas(pack, "c1 int, c2 int, rows binary, ids binary, labels binary, data binary"), "index-blocks"
    )
    anchors = stored(filed.where(F.pmod("id", F.lit(every)) == 0).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "label", "q"), "index-anchors")
    return _Search(filed, index, blocks, anchors, anchors.count())


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, every: int = 100, scale: float = 256.0,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are rows whose id is divisible by ``every``. A score is the integer inner
    product of ``floor(scale * x)``; higher scores come first, ties by smaller id. An
    anchor's positives are its first ``positives`` other rows of the same label. For
    each, the first ``negatives`` rows of other labels are returned whose score is from
    ``low`` to ``high`` hundredths of the positive's. The result is exact; the sample of
    the codebooks only steers the search.

    Rows with a null id, label or vector, or with a null or non-finite component take
    no part. Labels are integers. Shorter vectors are filled with zeros, an empty one is
    all zeros. Rows of a repeated id are rows of their own, each an anchor, positive or
    negative; an anchor without positives, or a positive without negatives, has no rows.
    Other columns are ignored, whatever their names. Products are expected to fit 62 bits.
    """
    spark = vectors.sparkSession
    rows = stored(quantized(vectors, id_col, vec_col, label_col, scale).select(F.monotonically_increasing_id().alias("row"), "*"), "index-rows")
    search = _search(rows, every)
    if search is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = search.anchors.select("anchor", F.lit(0).cast("long").alias("window"), F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high"))
    near = search.best(whole, positives, True).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Positives of one score share their window. Its ends are whole hundredths, rounded inwards.
    of_100, to_100 = f"({low} * positive_score)", f"({high} * positive_score)"
    asked = near.select(
        "anchor", F.col("positive_score").alias("window"),
        F.expr(f"({of_100} + pmod(-{of_100}, 100)) div 100").alias("low"), F.expr(f"({to_100} - pmod({to_100}, 100)) div 100").alias("high"),
    ).where("low <= high").distinct()
    far = search.best(stored(asked, "index-windows"), negatives, False)
    far = far.select("anchor", F.col("window").alias("positive_score"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        near.join(far, ["anchor", "positive_score"]).join(search.anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
