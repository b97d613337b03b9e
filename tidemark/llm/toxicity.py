"""Toxicity by logistic regression learned with FTRL-proximal over hashed n-grams.

A text is the set of its words, word pairs, and pairs with one or two words between,
each hashed to one of ``2**bits`` coordinates. Training goes once or more over a
bounded sample of labelled rows; each coordinate has its own learning rate and L1
keeps most weights at exactly zero, so the model is a short list that every task
gets. Scoring reads whole texts in Arrow batches and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out
from tidemark.llm.hashing import GOLDEN, mixed, offsets, word_hashes

SPANS = (0, 1, 2, 3)  # a word alone, then pairs at these distances
INTERCEPT = -1
CHUNK = 256


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 4


def _bins(words: np.ndarray, span: int, bits: int) -> np.ndarray:
    if span == 0:
        keys = words
    elif len(words) > span:
        keys = mixed(words[:-span] * np.uint64(GOLDEN) + words[span:] + np.uint64(span))
    else:
        keys = words[:0]
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def features(texts: Sequence[str | None], bits: int) -> list[np.ndarray]:
    """The set of coordinates of each text."""
    words, counts = word_hashes(texts)
    at = offsets(counts)
    return [
        np.unique(np.concatenate([_bins(words[a:b], span, bits) for span in SPANS])) for a, b in zip(at[:-1], at[1:])
    ]


def fit_ftrl(texts: Sequence[str | None], toxic: Sequence[int], how: Ftrl) -> tuple[float, np.ndarray]:
    """The intercept and the weights after going over the rows in order."""
    size = (1 << how.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    rows: list[np.ndarray] = []
    for i in range(0, len(texts), CHUNK):
        rows += [np.append(f, size - 1).astype(np.int32) for f in features(texts[i : i + CHUNK], how.bits)]

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= how.l1, 0.0, -(zs - np.sign(zs) * how.l1) / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2))

    for _ in range(how.epochs):
        for at, label in zip(rows, toxic):
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            ns = n[at]
            sigma = (np.sqrt(ns + gradient * gradient) - np.sqrt(ns)) / how.alpha
            z[at] += gradient - sigma * w
            n[at] = ns + gradient * gradient
    final = weights(slice(None))
    return float(final[-1]), final[:-1]


def score_texts(texts: Sequence[str | None], intercept: float, weights: np.ndarray, bits: int) -> np.ndarray:
    """The probability of each text to be toxic; a feature counts once per text."""
    sums = np.full(len(texts), intercept)
    for i in range(0, len(texts), CHUNK):
        words, counts = word_hashes(texts[i : i + CHUNK])
        of = np.repeat(np.arange(len(counts)), counts)
        hits = []
        for span in SPANS:
            bins = _bins(words, span, bits)
            end = len(bins)
            heavy = np.flatnonzero((weights[bins] != 0) & (of[:end] == of[span : span + end]))
            hits.append(of[heavy] * len(weights) + bins[heavy])
        found = np.unique(np.concatenate(hits))
        np.add.at(sums, i + found // len(weights), weights[found % len(weights)])
    return 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = 16_000, how: Ftrl = Ftrl(), id_col: str = "doc_id", text_col: str = "text"
) -> tuple[float, list[tuple[int, float]]]:
    """The intercept and the non-zero weights from at most ``sample`` labelled rows.

    The sample is by the hash of the id, over rows that are not held out. A document
    labelled more than once is toxic if any label says so; null labels do not count.
    """
    marked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    )
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(marked), F.col("id") == F.col("label_id"))  # at most `sample` small rows
        .select("id", "text", F.col("toxic").cast("int").alias("toxic"))
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("id"), "id", "text")
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch["text"].tolist()
            toxic += batch["toxic"].tolist()
        if texts:
            intercept, weights = fit_ftrl(texts, toxic, how)
            at = np.flatnonzero(weights)
            yield pd.DataFrame({"bin": np.append(at, INTERCEPT), "weight": np.append(weights[at], intercept)})

    model = {r["bin"]: r["weight"] for r in rows.mapInPandas(learn, "bin long, weight double").collect()}
    return model.pop(INTERCEPT, 0.0), sorted(model.items())


def toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = 16_000, how: Ftrl = Ftrl(), threshold: float = 0.7,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents with held_out, score (0 to 1) and predicted (1 from ``threshold``).

    A null or empty text has the score of a text without features. Without any label
    every score is 0.5. Repeated rows are scored alike; all columns of ``docs`` are
    kept, except that held_out, score and predicted replace columns of these names.
    """
    intercept, weights = fit_toxicity(docs, labels, sample, how, id_col, text_col)
    # At most 2**bits numbers, and few of them: L1 leaves out the rest.
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 << how.bits)
        for at, weight in shared.value:
            dense[at] = weight
        for texts in batches:
            yield pd.Series(score_texts(texts.tolist(), intercept, dense, how.bits))

    return docs.withColumn("held_out", held_out(F.col(id_col))).withColumn("score", score(F.col(text_col))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
