"""Language identification by prediction by partial matching over bytes.

Each language has a variable-order context tree: for every context of up to
``order`` bytes seen in training, which bytes followed it and how often. A byte that
did not follow a context costs an escape (method C: the number of different
followers, over that plus all followers), and is then coded in the context shortened
by one byte; below the empty context all 256 bytes are equally likely. Counts are
frozen after training, so a text's code length is a sum over its bytes and is exact.
The language with the shortest code is predicted.

Counting is a Spark aggregation over a bounded sample. The costs of all languages
for one context and byte stand side by side, so scoring looks a byte up once, at the
longest context, and goes to shorter ones only for what training never saw.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, stored
from tidemark.llm.hashing import mixed

UNKNOWN = "und"
NO_CONTEXT_BITS = 8.0
PIECE = 1 << 18


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes at each place as one number, from the first place that has so many."""
    places = max(0, len(data) - n + 1)
    out = np.zeros(places, dtype=np.uint64)
    for k in range(n):
        out = (out << np.uint64(8)) | data[k : k + places]
    return out


def count_grams(texts: Sequence[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths 1 to order + 1, byte strings as numbers, and how often each occurs."""
    sizes, grams, counts = [], [], []
    for n in range(1, order + 2):
        found = [_grams(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), n) for t in texts]
        values, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, int))
        sizes.append(np.full(len(values), n))
        grams.append(values)
        counts.append(times)
    return np.concatenate(sizes), np.concatenate(grams), np.concatenate(counts)


class _Table:
    """Numbers to row indexes by hashing; what collides goes to a smaller table behind."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray, salt: int = 0):
        self.salt = np.uint64(salt)
        self.bits = max(8, int(len(keys)).bit_length() + 2)
        slots = self._slot(keys)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.rows = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys[slots] = keys
        self.rows[slots] = rows
        lost = self.keys[slots] != keys
        self.behind = _Table(keys[lost], rows[lost], salt + 1) if lost.any() else None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys + self.salt) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        slots = self._slot(keys)
        rows = np.where(self.keys[slots] == keys, self.rows[slots], -1)
        if self.behind is not None:
            missing = np.flatnonzero(rows < 0)
            if len(missing):
                rows[missing] = self.behind.find(keys[missing])
        return rows


@dataclass
class Counts:
    """Frozen counts: per language and length of byte string, the strings and their counts."""

    languages: list[str]
    order: int
    grams: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


class PpmModel:
    """Code lengths of all languages from frozen counts."""

    def __init__(self, counts: Counts):
        self.languages, self.order = counts.languages, counts.order
        width = len(self.languages)
        self.tables: list[_Table] = []
        self.costs: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []  # by context; the last row is of unseen contexts
        self.contexts: list[_Table | None] = []
        for n in range(1, self.order + 2):
            empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            own = [counts.grams.get((i, n), empty) for i in range(width)]
            contexts = np.unique(np.concatenate([g >> np.uint64(8) for g, _ in own]))
            escape = np.zeros((len(contexts) + 1, width))
            grams = np.unique(np.concatenate([g for g, _ in own]))
            cost = np.full((len(grams), width), np.inf)
            for i, (g, c) in enumerate(own):
                if not len(g):
                    continue
                place = np.searchsorted(contexts, g >> np.uint64(8))
                total = np.bincount(place, c, minlength=len(contexts) + 1)
                kinds = np.bincount(place, minlength=len(contexts) + 1)
                seen = kinds > 0
                escape[seen, i] = np.log2((total + kinds)[seen] / kinds[seen])
                cost[np.searchsorted(grams, g), i] = np.log2((total + kinds)[place] / c)
            self.contexts.append(_Table(contexts, np.arange(len(contexts))))
            self.escapes.append(escape)
            # What a language did not see here, it codes by an escape and the shorter context.
            unseen = np.isinf(cost)
            if len(grams):
                shorter = self._cost(grams & np.uint64(256 ** (n - 1) - 1), n - 1)
                through = escape[np.searchsorted(contexts, grams >> np.uint64(8))] + shorter
                cost[unseen] = through[unseen]
            self.tables.append(_Table(grams, np.arange(len(grams))))
            self.costs.append(cost)

    def _cost(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Bits of the last byte after the bytes before it, for all languages."""
        if n == 0:
            return np.full((len(grams), len(self.languages)), NO_CONTEXT_BITS)
        rows = self.tables[n - 1].find(grams)
        out = np.take(self.costs[n - 1], rows, axis=0, mode="clip") if len(self.costs[n - 1]) else np.zeros((len(grams), len(self.languages)))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            rest = grams[missing]
            context = self.contexts[n - 1].find(rest >> np.uint64(8))
            out[missing] = self.escapes[n - 1][context] + self._cost(rest & np.uint64(256 ** (n - 1) - 1), n - 1)
        return out

    def code_lengths(self, texts: Sequence[bytes]) -> np.ndarray:
        """Bits of each text in each language; a text's first bytes have shorter contexts."""
        bits = np.zeros((len(texts), len(self.languages)))
        parts: list[tuple[int, bool, bytes]] = []
        size = 0
        for i, data in enumerate(texts):
            for at in range(0, max(1, len(data) - self.order), PIECE):
                parts.append((i, at == 0, data[at : at + PIECE + self.order]))
                size += len(parts[-1][2])
                if size >= PIECE:
                    self._add(parts, bits)
                    parts, size = [], 0
        if parts:
            self._add(parts, bits)
        return bits

    def _add(self, parts: list[tuple[int, bool, bytes]], bits: np.ndarray) -> None:
        of = np.array([i for i, _, _ in parts])
        first = np.array([begins for _, begins, _ in parts])
        length = np.array([len(data) for _, _, data in parts])
        start = np.cumsum(length) - length
        raw = np.frombuffer(b"".join(data for _, _, data in parts), dtype=np.uint8)
        for n in range(1, self.order + 1):
            long_enough = np.flatnonzero(first & (length >= n))
            gram = np.zeros(len(long_enough), dtype=np.uint64)
            for k in range(n):
                gram = (gram << np.uint64(8)) | raw[start[long_enough] + k]
            bits[of[long_enough]] += self._cost(gram, n)
        full = np.flatnonzero(length > self.order)
        if not len(full):
            return
        counts = length[full] - self.order
        ends = np.cumsum(counts)
        places = np.arange(ends[-1]) + np.repeat(start[full] - (ends - counts), counts)
        costs = self._cost(_grams(raw, self.order + 1)[places], self.order + 1)
        np.add.at(bits, of[full], np.add.reduceat(costs, ends - counts, axis=0))

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of the shortest code and its share among all languages' probabilities."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        bits = self.code_lengths([(t or "").encode("utf-8", "surrogatepass") for t in texts])
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(texts)), best]
        shares = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        known = np.array([t is not None for t in texts], dtype=bool)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        scores = np.where(known, shares, 0.0)
        return names, scores


def fit_ppm(
    docs: DataFrame, per_language: int = 150, order: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Counts:
    """Counts from at most ``per_language`` documents of each language, by the hash of the id.

    Only documents that are not held out, with a language and a text, are learned from.
    Expects few languages; their names and the counts of the bounded sample come to
    the driver.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    # Keys only are ranked; the limit per group is applied before the shuffle as well.
    first = Window.partitionBy("lang").orderBy("place", "id", "copy")
    keys = usable.select("lang", "id", F.xxhash64("id").alias("place"), F.xxhash64("text").alias("copy"))
    chosen = keys.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_language)
    chosen = stored(chosen.select("lang", "id", "copy").distinct(), "ppm-sample")
    sample = usable.withColumn("copy", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "id", "copy"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                sizes, grams, counts = count_grams(part["text"].tolist(), order)
                yield pd.DataFrame({"lang": lang, "size": sizes, "gram": grams.astype(np.int64), "n": counts})

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, size int, gram long, n long")
    found = counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    grams = {
        (languages.index(lang), size): (part["gram"].to_numpy().astype(np.uint64), part["n"].to_numpy())
        for (lang, size), part in found.groupby(["lang", "size"])
    }
    return Counts(languages, order, grams)


def identify_language(
    docs: DataFrame, per_language: int = 150, order: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The documents with held_out, lang_pred and score (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or no language was
    learned. Equally short codes go to the first language by alphabet. Repeated rows
    are judged alike; all columns of ``docs`` are kept, except that held_out,
    lang_pred and score replace columns of these names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_ppm(docs, per_language, order, id_col, text_col, lang_col))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = PpmModel(shared.value)
        for texts in batches:
            names, scores = model.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    lettered = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    return (
        docs.withColumn("held_out", held_out(F.col(id_col)))
        .withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")})
        .withColumn("__found", predict(lettered))
        .withColumns({"lang_pred": F.col("__found.lang_pred"), "score": F.col("__found.score")})
        .drop("__found")
    )
