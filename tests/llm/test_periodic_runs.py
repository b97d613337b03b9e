"""Periodic runs of words against a plain search by period."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

import llm.brute as brute
from tidemark.llm.periodic_runs import CoverSuffixes, block_runs, find_runs, looped, text_runs
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words):
    """(start, period, length) of all runs, period by period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, q, n) for (s, n), q in found.items())


def plain_looped(doc_id, text):
    words = split(text)
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def plain_row(doc_id, text):
    words = plain_looped(doc_id, text)
    runs = plain_runs(words)
    keep = [True] * len(words)
    for s, q, n in runs:
        keep[s + q : s + n] = [False] * (n - q)
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, q, n in runs).encode()).hexdigest()
    text = hashlib.sha256(" ".join(w for w, k in zip(words, keep) if k).encode()).hexdigest()
    s, q, n = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else (None, None, None)
    return doc_id, len(runs), s, n, q, n and 1000 * n // q, digest, text


def sequences():
    chance = random.Random(3)
    for _ in range(400):
        out = []
        while len(out) < chance.randrange(0, 120):
            unit = [chance.randrange(3) for _ in range(chance.randrange(1, 12))]
            out += (unit * chance.randrange(1, 9))[: chance.randrange(1, 60)]
        yield out
    yield [0] * 500
    yield [0, 1] * 300 + [0]
    yield (list(range(40)) * 9 + [7]) * 6


def test_extensions_equal_plain_ones():
    chance = np.random.default_rng(5)
    for size in (1, 2, 14, 60, 700):
        words = np.append(np.tile(chance.integers(0, 2, max(1, size // 3)), 3)[:size], 9)
        a, b = np.triu_indices(len(words), 1)
        some = chance.permutation(len(a))[:3000]
        a, b = a[some], b[some]
        got = CoverSuffixes(words).extension(a, b)
        for x, y, n in zip(a, b, got):
            want = 0
            while y + want < len(words) and words[x + want] == words[y + want]:
                want += 1
            assert n == want


def test_runs_equal_plain_ones():
    documents = [np.array(s, dtype=np.int64) for s in sequences()]
    doc, start, length, period = block_runs(documents)
    got = list(zip(doc.tolist(), start.tolist(), period.tolist(), length.tolist()))
    assert got == [(i, *run) for i, words in enumerate(documents) for run in plain_runs(words.tolist())]
    assert [len(x) for x in block_runs([])] == [0, 0, 0, 0]


def test_one_word_repeated_very_often_is_one_run():
    began = time.time()
    (words, start, length, period), = text_runs(["a " * 300_000])
    assert (len(words), start.tolist(), length.tolist(), period.tolist()) == (300_000, [0], [300_000], [1])
    assert time.time() - began < 60


def test_awkward_rows_equal_plain_ones(spark):
    texts = [None, "", " \n\t", "a", "a a a a a a", "a a a a a", "A a A a A a A a", "x\x0by\x0cx\ry x y x y", "é 日 é 日 é 日 é 日 z", "a a " * 8]
    texts += [(5, "a b " * 9), (5, "a b " * 9), (None, "a b " * 9), (-3, "w " * 30)]
    texts += [(i, " ".join(f"w{(i * k) % 37}" for k in range(200))) for i in range(20, 70)] + [(99, "q r s " * 5000 + "tail")]
    docs = brute.documents(spark, texts)
    want = sorted((plain_row(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    from tidemark.llm.queries import run_columns

    changed = docs.withColumn("text", looped(docs["doc_id"], docs["text"]))
    assert sorted(map(tuple, run_columns(find_runs(changed)).collect()), key=repr) == want
    assert find_runs(docs.where("false")).count() == 0


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_equals_plain_search(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, folder).collect()))
    assert got == sorted(plain_row(*r) for r in docs)
