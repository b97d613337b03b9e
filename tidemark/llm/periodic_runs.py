"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)`` words
long, that no neighbouring word extends. In it the words q apart are equal over
``length - q`` places, so one of every ``least_stretch(q)`` places meets it: these
places, for all periods, are the harmonic grid, about ``n * log(n) / 3`` of them. From
a grid place whose word recurs q later the match is followed to both sides.

Few words are compared for that. Every two places reach, within ``COVER_PERIOD``
words, two places of the difference cover at once; a match that has not ended by then
is read from the sorted suffixes of cover places only: their common prefix is the
least of the prefixes between them, by a sparse table. The suffixes are sorted by
doubling, and only for documents that have such a match.

Documents are independent of each other; a block of them is handled at once, with a
word of its own between each two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A perfect difference set. Each residue is a difference of two of its members.
COVER_PERIOD = 13
COVER = (0, 1, 3, 9)
LEAST_WORDS = 6
LEAST_PERIODS = 4
BLOCK_WORDS = 1 << 16
GRID_PLACES = 1 << 19

_in_cover = np.isin(np.arange(COVER_PERIOD), COVER)
_slot = np.cumsum(_in_cover) - 1
# Words from which two places of these residues are both in the cover.
_until_cover = np.array(
    [[next(d for d in range(COVER_PERIOD) if _in_cover[(a + d) % COVER_PERIOD] and _in_cover[(b + d) % COVER_PERIOD]) for b in range(COVER_PERIOD)] for a in range(COVER_PERIOD)]
)


def least_stretch(period: np.ndarray) -> np.ndarray:
    """Over how many places a run of this period has equal words, at least."""
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period) - period


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of keys, and each row's rank; equal rows share one."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), dtype=np.int64)
    for key in keys:
        sorted_key = key[order]
        fresh[1:] |= sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(fresh)
    return order, rank


class CoverSuffixes:
    """Common extensions of two places of a sequence whose last word occurs once."""

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        place = np.flatnonzero(_in_cover[np.arange(n) % COVER_PERIOD])
        padded = np.concatenate((words + 1, np.zeros(COVER_PERIOD + 1, dtype=np.int64)))
        wide = int(padded.max()) + 1
        two = padded[:-1] * wide + padded[1:]
        keys = [two[place + k] for k in range(0, COVER_PERIOD - 1, 2)] + [padded[place + COVER_PERIOD - 1]]
        order, rank = _dense(*keys)
        levels, ahead = [rank], len(COVER)  # a place's slot moves by this for each period
        while rank.max(initial=0) < len(rank) - 1:
            later = np.full(len(rank), -1, dtype=np.int64)
            later[: max(0, len(rank) - ahead)] = rank[ahead:]
            order, rank = _dense(rank, later)
            levels.append(rank)
            ahead *= 2
        self.rank = rank
        self.least = [self._adjacent(order, place, levels)]
        while 2 * (1 << (len(self.least) - 1)) <= len(self.least[0]):
            half, last = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _adjacent(self, order: np.ndarray, place: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """How many words each sorted suffix shares with the next one."""
        left, right = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(len(left), dtype=np.int64)
        for level in range(len(levels) - 1, -1, -1):
            equal = levels[level][left] == levels[level][right]
            shared[equal] += COVER_PERIOD << level
            left[equal] += len(COVER) << level
            right[equal] += len(COVER) << level
        first, second = place[left], place[right]
        open_ = np.ones(len(left), dtype=bool)
        for k in range(COVER_PERIOD):
            at = np.flatnonzero(open_)
            if not len(at):
                break
            # Behind the last word nothing is equal; that word itself occurs once.
            inside = np.maximum(first[at], second[at]) + k < len(self.words)
            open_[at] = inside
            at = at[inside]
            equal = self.words[first[at] + k] == self.words[second[at] + k]
            shared[at] += equal
            open_[at] = equal
        return shared

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each two places, how many words from there on are equal; a < b."""
        ahead = _until_cover[a % COVER_PERIOD, b % COVER_PERIOD]
        shared = np.zeros(len(a), dtype=np.int64)
        going = np.ones(len(a), dtype=bool)
        for k in range(int(ahead.max(initial=0))):
            at = np.flatnonzero(going & (k < ahead))
            equal = self.words[a[at] + k] == self.words[b[at] + k]
            shared[at] += equal
            going[at] = equal
        at = np.flatnonzero(going)
        if len(at):
            x, y = (self.rank[(p // COVER_PERIOD) * len(COVER) + _slot[p % COVER_PERIOD]] for p in (a[at] + ahead[at], b[at] + ahead[at]))
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(float))[1] - 1
            found = np.empty(len(at), dtype=np.int64)
            for k in np.unique(level):
                own = level == k
                found[own] = np.minimum(self.least[k][low[own]], self.least[k][high[own] - (1 << int(k))])
            shared[at] += found
        return shared


def _few(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Equal words from two places on, in one direction, counted to ``COVER_PERIOD``."""
    shared = np.zeros(len(a), dtype=np.int64)
    at = np.arange(len(a))
    for k in range(COVER_PERIOD):
        x, y = a[at] + step * k, b[at] + step * k
        at = at[(x >= 0) & (y < len(words))]
        at = at[words[a[at] + step * k] == words[b[at] + step * k]]
        shared[at] += 1
    return shared


def _grid(start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document, place and period of the harmonic grid, some places at a time."""
    periods = np.where(size >= LEAST_WORDS, size // LEAST_PERIODS, 0)
    doc = np.repeat(np.arange(len(size)), periods)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    stride = least_stretch(period)
    count = -(-(size[doc] - period) // stride)
    upto = np.cumsum(count)
    first = 0
    while first < len(doc):
        before = upto[first] - count[first]
        last = max(first + 1, int(np.searchsorted(upto, before + GRID_PLACES, side="right")))
        row = np.repeat(np.arange(first, last), count[first:last])
        nth = np.arange(len(row)) - (upto[row] - count[row] - before)
        yield doc[row], start[doc[row]] + nth * stride[row], period[row]
        first = last


def block_runs(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of every run, in this order.

    A document is an array of word numbers; equal words have equal numbers from 0 on.
    """
    words, start, size = _joined(documents)
    found = [np.zeros((4, 0), dtype=np.int64)]
    for doc, place, period in _grid(start, size):
        again = words[place] == words[place + period]
        doc, place, period = doc[again], place[again], period[again]
        ahead = _few(words, place, place + period, 1)
        behind = _few(words, place - 1, place + period - 1, -1)
        more = (ahead == COVER_PERIOD) | (behind == COVER_PERIOD)
        if more.any():
            ahead[more], behind[more] = _far(documents, doc[more], place[more] - start[doc[more]], period[more])
        long_enough = ahead + behind >= least_stretch(period)
        runs = np.stack((doc, place - behind - start[doc], ahead + behind + period, period))[:, long_enough]
        found.append(np.unique(runs, axis=1))
    doc, begin, length, period = np.concatenate(found, axis=1)
    # A stretch also has the multiples of its smallest period.
    order = np.lexsort((period, length, begin, doc))
    doc, begin, length, period = (x[order] for x in (doc, begin, length, period))
    smallest = np.ones(len(doc), dtype=bool)
    smallest[1:] = (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    doc, begin, length, period = (x[smallest] for x in (doc, begin, length, period))
    order = np.lexsort((length, period, begin, doc))
    return doc[order], begin[order], length[order], period[order]


def _joined(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sequence with a word of its own around each document; starts and sizes."""
    size = np.array([len(d) for d in documents], dtype=np.int64)
    top = max((int(d.max()) for d in documents if len(d)), default=-1) + 1
    parts = [np.array([top])]
    for i, d in enumerate(documents):
        parts += [d, np.array([top + 1 + i])]
    return np.concatenate(parts).astype(np.int64), np.cumsum(size + 1) - size, size


def _far(documents: list[np.ndarray], doc: np.ndarray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal words ahead of and behind places whose match is longer than a few words."""
    needed, own = np.unique(doc, return_inverse=True)
    words, start, _ = _joined([documents[d] for d in needed])
    at = place + start[own]
    ahead = CoverSuffixes(words).extension(at, at + period)
    back = len(words) - 1 - at
    behind = CoverSuffixes(words[::-1].copy()).extension(back - period + 1, back + 1)
    return ahead, behind


def text_runs(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Words, and start, length and period of the runs, of each text in turn."""
    block: list[list[bytes]] = []
    held = 0
    for text in texts:
        block.append((text or "").encode("utf-8", "surrogatepass").split())
        held += len(block[-1])
        if held >= BLOCK_WORDS:
            yield from _runs_of(block)
            block, held = [], 0
    yield from _runs_of(block)


def _runs_of(block: list[list[bytes]]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    numbers: dict[bytes, int] = {}
    numbered = [np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64) for words in block]
    doc, start, length, period = block_runs(numbered)
    edges = np.searchsorted(doc, np.arange(len(block) + 1))
    for i, words in enumerate(block):
        own = slice(edges[i], edges[i + 1])
        yield words, start[own], length[own], period[own]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words outside runs and the first period of each, joined by one space."""
    if len(start):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``runs`` by start, then period, and ``collapsed``.

    Words are separated by ``[\\x20\\x09-\\x0D]`` and numbered from 0; a run has start,
    length and period. ``collapsed`` is the text without the words that a run holds
    after its first period, joined by single spaces.

    Null and empty texts have no words, no runs and an empty collapsed text. Repeated
    rows and null ids are judged row by row. Long texts are taken whole. No documents
    give no rows. Other columns are ignored, whatever their names.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs, texts = [], []
            for words, start, length, period in text_runs(batch["text"].tolist()):
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in zip(start.tolist(), length.tolist(), period.tolist())])
                texts.append(collapsed(words, start, length, period))
            yield pd.DataFrame({"id": batch["id"], "runs": runs, "collapsed": texts})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInPandas(search, "id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def looped(doc_id: Column, text: Column) -> Column:
    """The text; where crc32 of the id is divisible by 10, with a tail that repeats itself.

    With h the crc32 of the decimal id and g = h div 10, the n words from a = g mod n
    on repeat the first p = 1 + (n - a) div (3 + g mod 8) of them. A null id has no crc32
    and its text stays.
    """
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    unit = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)


def runs_digest(runs: Column) -> Column:
    """sha256 of a line ``start,length,period`` for each run."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of several the one with the smallest start, then period. Null without runs."""
    ranked = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))
    )
    return F.array_min(ranked)
