"""Benchmark leaks against alignments of every document with every item."""

from __future__ import annotations

import random
import re
import unicodedata

import numpy as np

import llm.brute as brute
from tidemark.llm import plain_words
from tidemark.llm.decontamination import find_leaks, untestable_items
from tidemark.llm.plain_words import plain_word_hashes

CHANCE = random.Random(8)


def plain(text):
    out = []
    for c in text or "":
        alone = re.match("[぀-ヿ一-鿿ก-ฺเ-๎]", c)
        inside = unicodedata.category(c)[0] in "LN"
        out.append(f" {c} " if alone and inside else c.lower()[0] if inside else " ")
    return "".join(out).split()


def test_words_are_letters_and_digits(monkeypatch):
    texts = ["Élan, vital_2 x'y", None, "", "…", "水と火 fire", "A" * 50, "ΑΣ ας Ⅷ ½", "don't STOP \U0001d400", "ab cd " * 40, "เมืองหลวง"]
    for piece in (plain_words.PIECE, 7):
        monkeypatch.setattr(plain_words, "PIECE", piece)
        hashes, counts = plain_word_hashes(texts)
        assert counts.tolist() == [len(plain(t)) for t in texts]
        want = [w for t in texts for w in plain(t)]
        names = {}
        for w, h in zip(want, hashes.tolist()):
            assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)


def edited(words, share):
    out = []
    for w in words:
        draw = CHANCE.random()
        out += [] if draw < share / 3 else [w, "new"] if draw < 2 * share / 3 else ["other"] if draw < share else [w]
    return out


def test_leaks_equal_plain_alignments(spark):
    items = [[f"w{CHANCE.randrange(2500)}" for _ in range(CHANCE.randrange(3, 60))] for _ in range(12)]
    texts = []
    for i in range(60):
        text = [f"w{CHANCE.randrange(2500)}" for _ in range(CHANCE.randrange(0, 120))]
        if i % 2:
            item = CHANCE.choice(items)
            copy = edited(item, CHANCE.choice([0, 0.1, 0.3, 0.6])) if i % 4 == 1 else item[: len(item) * CHANCE.randrange(1, 10) // 9]
            at = CHANCE.randrange(len(text) + 1)
            text = text[:at] + copy + text[at:]
        texts.append(" ".join(text))
    docs = brute.documents(spark, texts)
    table = spark.createDataFrame([(i, ", ".join(words).title()) for i, words in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in find_leaks(docs, table).collect()}
    want = {}
    for d, text in enumerate(texts):
        words = text.split()
        grams = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        for i, item in enumerate(items):
            score = brute.smith_waterman(item, words) / (2 * len(item))
            if score >= 0.5 and any(tuple(item[k : k + 3]) in grams for k in range(len(item) - 2)):
                want[d, i] = score
    assert got == want and len(want) >= 15


def test_short_commonplace_items_are_untestable(spark):
    texts = [f"the cat of {i} " + "the " * (i % 3) for i in range(60)] + ["a rare thing", "the cat sat on a mat of reeds"]
    docs = brute.documents(spark, texts)
    table = spark.createDataFrame([(1, "the"), (2, "The cat of"), (3, "rare"), (4, "the cat sat on a mat of reeds"), (5, None)], "item_id long, text string")
    assert {r["item_id"] for r in untestable_items(docs, table).collect()} == {1, 2}
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, table).collect()} == {(60, 3), (61, 4)}
    assert untestable_items(docs, table.where("false")).count() == 0
    assert np.size(plain_word_hashes([])[0]) == 0
