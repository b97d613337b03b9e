"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

The n-grams of the test items are looked up in all documents once to count in how
many each occurs. Those as rare as the n-grams around them become seeds; commonplace
ones, in many times more documents than their neighbours, do not. Within a passage
that leaked often all are equally frequent and stay seeds. A second reading joins
documents to items by seeds; where seeds of an item lie close together, item and passage are aligned
word by word. The score is the alignment's share of the item's score with itself,
so edited and paraphrased copies score below 1 but far above chance.

Test items are taken in blocks of bounded size; each block is sent to all tasks, and
documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.hashing import chained, offsets
from tidemark.llm.plain_words import plain_word_hashes

BLOCK_CHARS = 8_000_000
BLOCK_TEXTS = 512
FILTER_BITS = 22
MATCH, MISMATCH, GAP = 2, -1, -1

_u = np.uint64


@dataclass(frozen=True)
class Seeds:
    """n-grams of ``width`` words, what makes one commonplace, and the least share to report.

    Commonplace is one in over ``common`` documents, and in over ``times`` as many as
    the median of its ``near`` neighbours on either side. An item of fewer than
    ``short`` words is untestable if over ``common`` documents hold each of its n-grams.
    """

    width: int = 3
    near: int = 4
    times: int = 10
    common: int = 20
    short: int = 6
    least: float = 0.5


def grams_of(words: np.ndarray, width: int) -> np.ndarray:
    """All n-grams; a shorter text is one gram as a whole."""
    return chained(words, min(width, len(words))) if len(words) else words


@dataclass
class Items:
    """Test items as word hashes, and where each of their n-grams stands."""

    ids: list[int]
    words: list[np.ndarray]
    width: int
    gram: np.ndarray = field(init=False)
    item: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        grams = [grams_of(w, self.width) for w in self.words]
        sizes = np.array([len(g) for g in grams], dtype=np.int64)
        self.gram = np.concatenate([np.zeros(0, np.uint64), *grams])
        self.item = np.repeat(np.arange(len(grams)), sizes)
        self.place = np.arange(len(self.gram)) - np.repeat(np.cumsum(sizes) - sizes, sizes)

    def widths(self) -> list[int]:
        return sorted({min(self.width, len(w)) for w in self.words if len(w)})


class _Lookup:
    """Which of many hashes are in a sorted list, by a bit table first."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = np.unique(wanted)
        self.table = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.table[self._slot(self.wanted)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _u(64 - FILTER_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes``, and the indexes in ``wanted`` found there."""
        maybe = np.flatnonzero(self.table[self._slot(hashes)])
        at = np.minimum(np.searchsorted(self.wanted, hashes[maybe]), max(0, len(self.wanted) - 1))
        sure = self.wanted[at] == hashes[maybe] if len(self.wanted) else np.zeros(len(maybe), bool)
        return maybe[sure], at[sure]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and where it ends in the passage."""
    slope = -GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        fresh = np.maximum(row + GAP, 0)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + step)
        row = np.maximum.accumulate(fresh + slope) - slope  # gaps along the passage
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _share(item: np.ndarray, passage: np.ndarray, least: float) -> tuple[float, int, int]:
    """Score share, start and end of the best alignment; 0 if it can't reach ``least``."""
    whole = MATCH * len(item)
    # No alignment scores more than its matching words, whatever their order.
    values, need = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(values, passage), len(values) - 1)
    have = np.bincount(at[values[at] == passage], minlength=len(values))
    if MATCH * np.minimum(need, have).sum() < least * whole:
        return 0.0, 0, 0
    score, end = align(item, passage)
    if score < least * whole:
        return 0.0, 0, 0
    _, back = align(item[::-1], passage[:end][::-1])
    return score / whole, end - back, end


def find_items(
    texts: list[str], items: Items, lookup: _Lookup, seed: np.ndarray, least: float
) -> Iterator[tuple[int, int, float, int, int]]:
    """Text index, item index, score, first word and word behind the last, for each leaked item.

    ``seed`` holds indexes into the items' n-grams, sorted by their hash.
    """
    words, counts = plain_word_hashes(texts)
    at = offsets(counts)
    text_of = np.repeat(np.arange(len(texts)), counts)
    spots, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    seed_grams = items.gram[seed]
    for width in items.widths():
        grams = chained(words, width)
        found, which = lookup.find(grams)
        inside = text_of[found] == text_of[found + width - 1]
        found, which = found[inside], which[inside]
        low = np.searchsorted(seed_grams, lookup.wanted[which], side="left")
        high = np.searchsorted(seed_grams, lookup.wanted[which], side="right")
        times = high - low
        spots.append(np.repeat(found, times))
        owners.append(seed[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)])
    spot, owner = np.concatenate(spots), np.concatenate(owners)
    if not len(spot):
        return
    item, text = items.item[owner], text_of[spot]
    begin = spot - items.place[owner]  # where the item would start
    order = np.lexsort((begin, item, text))
    item, text, begin = item[order], text[order], begin[order]
    size = np.array([len(w) for w in items.words])[item]
    apart = np.ones(len(item), dtype=bool)
    apart[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (begin[1:] - begin[:-1] > size[1:])
    starts = np.flatnonzero(apart)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for first, last in zip(starts, np.append(starts[1:], len(item)) - 1):
        i, t, n = int(item[first]), int(text[first]), int(size[first])
        low = max(int(at[t]), int(begin[first]) - n // 2 - 1)
        high = min(int(at[t + 1]), int(begin[last]) + n + n // 2 + 1)
        score, start, end = _share(items.words[i], words[low:high], least)
        if score and (score, -start) > (best.get((t, i), (0.0, 0, 0))[0], -best.get((t, i), (0.0, 0, 0))[1]):
            best[t, i] = score, start + low - int(at[t]), end + low - int(at[t])
    for (t, i), (score, start, end) in best.items():
        yield t, i, score, start, end


def choose_seeds(items: Items, frequency: np.ndarray, how: Seeds) -> np.ndarray:
    """Indexes of the items' n-grams that are seeds, sorted by n-gram.

    No seeds are the commonplace n-grams, and all those of untestable items.
    """
    seed = ~untestable(items, frequency, how)[items.item]
    start = np.searchsorted(items.item, np.arange(len(items.words) + 1))
    for k in np.flatnonzero(seed & (frequency > how.common)):
        low, high = start[items.item[k]], start[items.item[k] + 1]
        around = frequency[max(low, k - how.near) : min(high, k + how.near + 1)]
        seed[k] = frequency[k] <= how.times * max(1.0, float(np.median(around)))
    seeds = np.flatnonzero(seed)
    return seeds[np.argsort(items.gram[seeds], kind="stable")]


def untestable(items: Items, frequency: np.ndarray, how: Seeds) -> np.ndarray:
    """Which items are too short and commonplace for a match to mean a leak."""
    rarest = np.full(len(items.words), np.iinfo(np.int64).max)
    np.minimum.at(rarest, items.item, frequency)
    size = np.array([len(w) for w in items.words], dtype=np.int64)
    return (size > 0) & (size < how.short) & (rarest > how.common)


def _blocks_of(benchmark: DataFrame, width: int) -> Iterator[Items]:
    """The test items in blocks of bounded size, each read by the driver in turn."""
    tests = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars // BLOCK_CHARS) + 1
    tests = stored(tests.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "leak-items")
    for block in range(blocks):
        rows = sorted(
            ((r["item_id"], r["text"]) for r in tests.where(F.col("block") == block).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])
        )
        words, counts = plain_word_hashes([text for _, text in rows])
        yield Items([i for i, _ in rows], np.split(words, np.cumsum(counts)[:-1]) if rows else [], width)


def _texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, how: Seeds = Seeds(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, first_word, end_word, text_hash.

    ``benchmark`` has item_id and text. Words are runs of letters and digits,
    lower-cased, and single characters in scripts without spaces; the score is the best
    local alignment's, as a share of the item's score with itself, and at least
    ``how.least``.

    Null or empty texts and items hold nothing and match nothing. An item shorter
    than a seed is one seed as a whole; one that ``untestable_items`` names is not
    looked for. Repeated rows give repeated results; a null id stays null. Items that
    occur twice are found twice. Without documents or items there are no rows. Other
    columns are ignored, whatever their names.
    """
    texts = _texts_of(docs, id_col, text_col)
    result = None
    for items in _blocks_of(benchmark, how.width):
        part = _leaks_of(texts, docs.sparkSession.sparkContext.broadcast(items), items, how)
        result = part if result is None else result.union(part)
    return result.select(F.col("id").alias(id_col), "item_id", "score", "first_word", "end_word", "text_hash")


def untestable_items(
    docs: DataFrame, benchmark: DataFrame, how: Seeds = Seeds(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """item_id of the test items that are too short and commonplace to be looked for; those without words are none."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long")
    for items in _blocks_of(benchmark, how.width):
        frequency = _frequency(_texts_of(docs, id_col, text_col), spark.sparkContext.broadcast(items), items)
        names = [(items.ids[i],) for i in np.flatnonzero(untestable(items, frequency, how))]
        found = found.union(spark.createDataFrame(names, "item_id long"))
    return found


def _frequency(texts: DataFrame, shared, items: Items) -> np.ndarray:
    """For each of the items' n-grams, in how many documents it occurs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        lookup = _Lookup(known.gram)
        total = np.zeros(len(lookup.wanted), dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), BLOCK_TEXTS):
                words, counts = plain_word_hashes(batch["text"].iloc[at : at + BLOCK_TEXTS].tolist())
                text = np.repeat(np.arange(len(counts)), counts)
                for width in known.widths():
                    found, which = lookup.find(chained(words, width))
                    inside = text[found] == text[found + width - 1]
                    once = np.unique(text[found[inside]] * max(1, len(total)) + which[inside])
                    total += np.bincount(once % max(1, len(total)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    counted = texts.select("text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    distinct, where = np.unique(items.gram, return_inverse=True)
    frequency = np.zeros(len(distinct), dtype=np.int64)
    for row in counted:
        frequency[row["gram"]] = row["n"]
    return frequency[where]


def _leaks_of(texts: DataFrame, shared, items: Items, how: Seeds) -> DataFrame:
    chosen = choose_seeds(items, _frequency(texts, shared, items), how)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        lookup = _Lookup(known.gram[chosen])
        for batch in batches:
            for at in range(0, len(batch), BLOCK_TEXTS):
                part = batch.iloc[at : at + BLOCK_TEXTS]
                found = list(find_items(part["text"].tolist(), known, lookup, chosen, how.least))
                if found:
                    row, item, score, first, end = zip(*found)
                    yield pd.DataFrame(
                        {
                            "id": part["id"].array.take(list(row)), "item_id": pd.array([known.ids[i] for i in item], dtype="Int64"),
                            "score": score, "first_word": first, "end_word": end, "text_hash": part["text_hash"].to_numpy()[list(row)],
                        }
                    )

    return texts.mapInPandas(search, "id long, item_id long, score double, first_word long, end_word long, text_hash long")
