"""Removal of byte windows that are repeated anywhere, by a depth-limited radix sort.

A window is what a suffix shows of itself within the threshold. Sorting all suffixes
to that depth by most-significant-digit passes leaves equal windows in one group and
throws out, pass by pass, what is already alone. The digits here are chosen so that
no pass has a row per suffix:

1. the anchor, the least hash of all ``gram``-byte strings within the window. Equal
   windows have it at the same place, and neighbours mostly share it, so a run of
   windows is one row, with one hash of all the text that the run spans. Runs that
   are equal as a whole are repeated as a whole.
2. anchors with unequal runs: each run is cut into chunks of windows by their
   distance to the anchor; the digit is the text that all windows of a chunk share.
   Chunks alone in it are thrown out, chunks equal as a whole are repeated as a whole.
3. what is left, windows around an edit or the end of a passage: the whole window.

All groups are counted by aggregations that combine before the shuffle, so a passage
in a third of all documents is one row per task. Texts are read in overlapping
pieces; only places and hashes are shuffled, and the text once for the removal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.hashing import BYTE, mixed, powers

PIECE = 1 << 20
PLACE = np.uint64((1 << 24) - 1)
CHUNKS = 16
BROADCAST_RUNS = 500_000

_u = np.uint64


@dataclass(frozen=True)
class Threshold:
    """Windows of ``window`` bytes, found by anchors of ``gram`` bytes."""

    window: int = 400
    gram: int = 100

    @property
    def grams(self) -> int:
        """Places an anchor can have in a window."""
        return self.window - self.gram + 1

    @property
    def chunk(self) -> int:
        return -(-self.grams // CHUNKS)


class _Hashed:
    """Hashes of any byte ranges of one buffer."""

    def __init__(self, raw: np.ndarray):
        power, self.inverse = powers(len(raw) + 1)
        self.sums = np.concatenate(([_u(0)], np.cumsum((BYTE[raw] | _u(1)) * power[: len(raw)], dtype=np.uint64)))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.inverse[start])


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each ``width`` neighbours."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, _u(2**64 - 1))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs(texts: list[bytes], limit: Threshold) -> tuple[np.ndarray, ...]:
    """All windows of the texts as runs that share an anchor.

    For each run: the text's index, the first window's start, the anchor's distance
    from it, the last window's distance from it, the anchor's hash, the run's hash.
    """
    length = np.array([len(t) for t in texts], dtype=np.int64)
    start = np.cumsum(length) - length
    counts = np.maximum(length - limit.window + 1, 0)
    if not counts.sum():
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + tuple(np.zeros(0, dtype=np.uint64) for _ in range(2))
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    hashed = _Hashed(raw)
    places = np.arange(len(raw) - limit.gram + 1)
    least = _sliding_least((hashed.of(places, places + limit.gram) & ~PLACE) | places.astype(np.uint64), limit.grams)
    at = np.arange(counts.sum()) + np.repeat(start - (np.cumsum(counts) - counts), counts)
    anchor = (least[at] & PLACE).astype(np.int64)
    begins = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (np.diff(at) != 1)))
    # Two texts can follow each other without a gap only if the window is one byte.
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(at)) - 1
    s, e, a = at[first], at[last], anchor[first]
    text = np.repeat(np.arange(len(texts)), counts)[first]
    shape = mixed((a - s).astype(np.uint64) + ((e - s).astype(np.uint64) << _u(32)))
    return text, s - start[text], a - s, e - s, hashed.of(a, a + limit.gram), mixed(hashed.of(s, e + limit.window) ^ shape)


def _pieces(rows: Iterator[tuple[int, bytes]], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lists of about PIECE bytes; a longer text comes in pieces, no window twice."""
    owner: list[int] = []
    shift: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, data in rows:
        for at in range(0, max(1, len(data) - window + 1), PIECE):
            owner.append(i)
            shift.append(at)
            parts.append(data[at : at + PIECE + window - 1])
            size += len(parts[-1])
            if size >= PIECE:
                yield owner, shift, parts
                owner, shift, parts, size = [], [], [], 0
    if parts:
        yield owner, shift, parts


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _occurrences(docs: DataFrame, limit: Threshold) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, hashes = batch["id"].array, batch["text_hash"].to_numpy()
            for owner, shift, parts in _pieces(((i, _bytes(t)) for i, t in enumerate(batch["text"])), limit.window):
                text, start, anchor, last, anchor_hash, run_hash = runs(parts, limit)
                row = np.array(owner)[text]
                yield pd.DataFrame(
                    {
                        "h": anchor_hash.view(np.int64), "g": run_hash.view(np.int64), "id": ids.take(row), "text_hash": hashes[row],
                        "start": start + np.array(shift)[text], "anchor": anchor.astype(np.int32), "last": last.astype(np.int32),
                    }
                )

    return docs.mapInPandas(find, "h long, g long, id long, text_hash long, start long, anchor int, last int")


def _chunks(segments: DataFrame, limit: Threshold) -> DataFrame:
    """Second digit: the chunks of each run, by distance to the anchor."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                yield chunks_of(batch.iloc[at : at + 1024])

    def chunks_of(rows: pd.DataFrame) -> pd.DataFrame:
        data = rows["segment"].tolist()
        length = np.array([len(x) for x in data], dtype=np.int64)
        base = np.cumsum(length) - length
        hashed = _Hashed(np.frombuffer(b"".join(data), dtype=np.uint8))
        anchor, last = rows["anchor"].to_numpy(dtype=np.int64), rows["last"].to_numpy(dtype=np.int64)
        h = rows["h"].to_numpy().view(np.uint64)
        out = []
        for chunk in range(CHUNKS):
            near, far = chunk * limit.chunk, (chunk + 1) * limit.chunk - 1  # distances to the anchor
            low, high = np.maximum(anchor - far, 0), np.minimum(anchor - near, last)  # windows of the run
            has = np.flatnonzero(low <= high)
            a, b = base[has] + low[has], base[has] + high[has]
            # All windows of the chunk reach from its nearest start to its farthest end.
            core_from, core_to = base[has] + anchor[has] - near, base[has] + anchor[has] - far + limit.window
            name = mixed(h[has] + _u(chunk))
            shape = mixed(low[has].astype(np.uint64) - anchor[has].astype(np.uint64) + (high[has] - anchor[has]).astype(np.uint64) * _u(1 << 20))
            out.append(
                pd.DataFrame(
                    {
                        "h": rows["h"].to_numpy()[has], "g": rows["g"].to_numpy()[has], "n": rows["n"].to_numpy()[has],
                        "low": low[has].astype(np.int32), "high": high[has].astype(np.int32),
                        "core": (hashed.of(core_from, core_to) ^ name).view(np.int64),
                        "whole": (mixed(hashed.of(a, b + limit.window) ^ shape) ^ name).view(np.int64),
                    }
                )
            )
        return pd.concat(out)

    return segments.select("h", "g", "n", "anchor", "last", "segment").mapInPandas(
        cut, "h long, g long, n long, low int, high int, core long, whole long"
    )


def _windows(chunks: DataFrame, limit: Threshold) -> DataFrame:
    """Third digit: each window of the chunks that are still open."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                yield windows_of(batch.iloc[at : at + 1024])

    def windows_of(rows: pd.DataFrame) -> pd.DataFrame:
        data = rows["segment"].tolist()
        length = np.array([len(x) for x in data], dtype=np.int64)
        base = np.cumsum(length) - length
        hashed = _Hashed(np.frombuffer(b"".join(data), dtype=np.uint8))
        low, high = rows["low"].to_numpy(dtype=np.int64), rows["high"].to_numpy(dtype=np.int64)
        counts = high - low + 1
        row = np.repeat(np.arange(len(rows)), counts)
        window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[row]
        at = base[row] + window
        distance = (rows["anchor"].to_numpy(dtype=np.int64)[row] - window).astype(np.uint64)
        name = mixed(rows["h"].to_numpy().view(np.uint64)[row] + distance)
        return pd.DataFrame(
            {
                "h": rows["h"].to_numpy()[row], "g": rows["g"].to_numpy()[row], "n": rows["n"].to_numpy()[row],
                "window": window.astype(np.int32), "whole": (hashed.of(at, at + limit.window) ^ name).view(np.int64),
            }
        )

    return chunks.select("h", "g", "n", "anchor", "low", "high", "segment").mapInPandas(
        split, "h long, g long, n long, window int, whole long"
    )


def repeated_runs(docs: DataFrame, limit: Threshold) -> tuple[DataFrame, DataFrame]:
    """All runs of windows by place, and the parts of runs that are repeated: h, g, low, high."""
    found = stored(_occurrences(docs, limit), "suffix-runs")
    kinds = stored(
        found.groupBy("h", "g").agg(
            F.count("*").alias("n"), F.min(F.struct("id", "text_hash", "start")).alias("at"),
            F.first("anchor").alias("anchor"), F.first("last").alias("last"),
        ),
        "suffix-kinds",
    )
    whole = kinds.where("n > 1").select("h", "g", F.lit(0).alias("low"), F.col("last").alias("high"))
    mixed_anchors = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select("h")
    unequal = stored(kinds.join(mixed_anchors, "h"), "suffix-unequal")
    # One text of each kind of run that is not settled yet.
    sought = unequal.groupBy(F.col("at.id").alias("at_id"), F.col("at.text_hash").alias("at_hash")).agg(
        F.collect_list(F.struct("h", "g", "n", "anchor", "last", F.col("at.start").alias("start"))).alias("runs")
    )
    if unequal.count() <= BROADCAST_RUNS:
        sought = F.broadcast(sought)

    def segments_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, wanted in zip(batch["text"], batch["runs"]):
                data = _bytes(text)
                yield pd.DataFrame(
                    [
                        (r["h"], r["g"], r["n"], r["anchor"], r["last"], data[r["start"] : r["start"] + r["last"] + limit.window])
                        for r in wanted
                    ],
                    columns=["h", "g", "n", "anchor", "last", "segment"],
                )

    texts = docs.join(sought, docs["id"].eqNullSafe(sought["at_id"]) & (docs["text_hash"] == sought["at_hash"]))
    segments = stored(
        texts.select("text", "runs").mapInPandas(segments_of, "h long, g long, n long, anchor int, last int, segment binary"),
        "suffix-segments",
    )
    chunks = _chunks(segments, limit)  # cheaper to make twice than to keep
    # Chunks equal as a whole count as one from here on.
    wholes = stored(
        chunks.groupBy("whole").agg(
            F.sum("n").alias("n"), F.first("core").alias("core"), F.min(F.struct("h", "g", "low", "high")).alias("chunk")
        ),
        "suffix-wholes",
    )
    equal = chunks.join(wholes.where("n > 1").select("whole"), "whole").select("h", "g", "low", "high")
    open_cores = wholes.groupBy("core").agg(F.count("*").alias("wholes")).where("wholes > 1").select("core")
    still_open = wholes.join(open_cores, "core").select("chunk.*", F.col("n").alias("times"))
    windows = stored(
        _windows(still_open.join(segments.select("h", "g", "anchor", "segment"), ["h", "g"]).withColumnRenamed("times", "n"), limit),
        "suffix-windows",
    )
    again = windows.groupBy("whole").agg(F.sum("n").alias("times")).where("times > 1").select("whole")
    single = windows.join(again, "whole").select("h", "g", F.col("window").alias("low"), F.col("window").alias("high"))
    return found, whole.union(equal).union(single)


def _cut(data: bytes, covered: list, window: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed spans, and the bytes that stay."""
    spans = [(s + low, s + high + window) for s, parts in covered for low, high in parts]
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    at = np.array(spans, dtype=np.int64)
    np.add.at(edge, at[:, 0], 1)
    np.add.at(edge, at[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
    begins = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return int(gone.sum()), begins, kept


def remove_repeats(
    docs: DataFrame, limit: Threshold = Threshold(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with n_bytes, n_removed, n_spans and the kept bytes.

    A byte goes if a string of ``limit.window`` bytes over it starts at any other
    place too, in the same document or another. Strings are judged on the input and
    never reach across documents; overlapping repeats count.

    A null text is an empty one, and an empty text stays empty. Rows with equal id
    and text are repeats of each other. Kept bytes may cut a character in two. All
    columns of ``docs`` are kept; the four new ones replace columns of their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).where(
        F.octet_length("text") >= limit.window
    )
    found, repeated = repeated_runs(keyed, limit)
    # Stored, so that both sides of the join are plain shuffles: a run that very many
    # places share is then split by adaptive execution.
    parts = stored(repeated.groupBy("h", "g").agg(F.collect_set(F.struct("low", "high")).alias("parts")), "suffix-parts")
    covered = (
        found.join(parts, ["h", "g"])
        .groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "parts")).alias("__covered"))
        .select(F.col("id").alias("__at_id"), F.col("text_hash").alias("__at_hash"), "__covered")
    )

    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(texts: pd.Series, covers: pd.Series) -> pd.DataFrame:
        rows = []
        for text, cover in zip(texts, covers):
            if text is None:
                rows.append((0, 0, None))
                continue
            rows.append(_cut(_bytes(text), [(c["start"], [(p["low"], p["high"]) for p in c["parts"]]) for c in cover], limit.window))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])

    joined = docs.join(
        covered, F.col(id_col).cast("long").eqNullSafe(F.col("__at_id")) & (F.xxhash64(text) == F.col("__at_hash")), "left"
    )
    # Only texts with something to remove go to Python.
    touched = F.when(F.col("__covered").isNotNull(), text)
    result = joined.withColumn("__cut", cut(touched, F.col("__covered")))
    return result.withColumns(
        {
            "n_bytes": F.octet_length(text).cast("long"), "n_removed": F.col("__cut.n_removed"), "n_spans": F.col("__cut.n_spans"),
            "kept": F.coalesce(F.col("__cut.kept"), text.cast("binary")),
        }
    ).drop("__cut", "__covered", "__at_id", "__at_hash")
