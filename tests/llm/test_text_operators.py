"""The text operators against plain versions, over rows with every awkward case."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

import llm.brute as brute
from tidemark.llm import hashing
from tidemark.llm.decontamination import align, find_leaks
from tidemark.llm.jaccard import Bands, may_be_similar, near_duplicates, signatures, sketch
from tidemark.llm.language import Counts, PpmModel, count_grams, identify_language
from tidemark.llm.line_dedup import LineRuns, dedup_lines
from tidemark.llm.suffix_dedup import Threshold, remove_repeats
from tidemark.llm.toxicity import Ftrl, toxicity

RANDOM = random.Random(5)


def prose(n, vocabulary=400):
    return " ".join(f"w{RANDOM.randrange(vocabulary)}" for _ in range(n))


BASE = [w for w in prose(60).split()]


def edited(at):
    words = list(BASE)
    for i in at:
        words[i] = f"x{i}"
    return " ".join(words)


AWKWARD = [
    None, "", "   \n\t ", "one", "One two  three", "one two three", " ".join(BASE), " ".join(BASE), edited([0]), edited([30]),
    edited([0, 59]), edited([20, 40]), edited([10, 25, 40]), prose(3000), prose(80) + "\n" + " ".join(BASE), "héé éà ü\x00z",
    (None, " ".join(BASE)), (None, None), (6, " ".join(BASE)), (6, "other text of the same id entirely here"),
]


def pairs_of(frame, *names):
    return sorted(map(tuple, frame.select(*names).collect()), key=repr)


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_near_duplicates_equal_all_pairs(spark):
    docs = brute.documents(spark, AWKWARD)
    got = pairs_of(near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_duplicates(rows_of(docs)), key=repr)


def test_near_duplicates_of_many_small_sets_and_chains(spark):
    texts = [edited(range(i)) for i in range(12)] + [prose(n, 3) for n in range(1, 12) for _ in range(6)]
    docs = brute.documents(spark, texts)
    got = pairs_of(near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_duplicates(rows_of(docs)), key=repr)


def test_no_documents(spark):
    docs = brute.documents(spark, ["x"]).where("false")
    assert near_duplicates(docs).count() == 0
    assert dedup_lines(docs).count() == 0
    assert remove_repeats(docs).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity(docs, labels).count() == 0
    assert identify_language(docs).count() == 0
    assert find_leaks(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    """Whatever is common or empty, and for every size, band and difference allowed."""
    rng = np.random.default_rng(3)
    bands = Bands()
    for size in [1, 2, 3, 4, 5, 7, 8, 9, 12, 20, 33, 64, 150]:
        for _ in range(25):
            a = rng.integers(0, 2**63, size=size).astype(np.uint64)
            room = size * 25 // 75  # additions, or this share of removals, keep 0.75
            b = np.unique(np.concatenate((a, rng.integers(0, 2**63, size=rng.integers(0, room + 1)).astype(np.uint64))))
            lost = rng.integers(0, size - -(-75 * len(b) // 100) + 1) if -(-75 * len(b) // 100) <= size else 0
            b = b[~np.isin(b, a[:lost])]
            a = np.unique(a)
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 75 * (len(a) + len(b) - shared) or np.array_equal(a, b):
                continue
            common = np.sort(rng.choice(a, size=rng.integers(0, len(a) + 1), replace=False))
            assert len(np.intersect1d(signatures(a, bands, common), signatures(b, bands, common)))
            bitmap = np.frombuffer(sketch(b), np.uint8)[None, :]
            assert may_be_similar(sketch(a), len(a), bitmap, np.array([len(b)]), 75)[0]


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = [t[1] if isinstance(t, tuple) else t for t in AWKWARD]
    whole = hashing.word_hashes(texts)
    monkeypatch.setattr(hashing, "PIECE", 64)
    parts = hashing.word_hashes(texts)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    assert whole[1].tolist() == [len(brute.words(t)) for t in texts]
    named = dict(zip([w for t in texts for w in brute.words(t)], whole[0].tolist()))
    assert len(set(named.values())) == len(named)


LINES = [
    "Terms of use apply\nfirst text", "terms of USE apply  \nsecond text of it\n\nshort", None, "", "\n", "Terms of use apply\nTerms of use apply",
    "only here, twice\nonly here, twice", (1, "second text of it\nnew line of one"), (None, "terms of use apply"), (None, "null line 1234"),
    (None, "null line 1234"), "ÀÉ line with accents\n\x0b terms of use apply", "\n".join(f"line number {i % 50}" for i in range(500)),
]


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup_equals_plain(spark, batches):
    docs = brute.documents(spark, LINES)
    got = dedup_lines(docs, batches=batches)
    assert set(docs.columns) - {"n_lines"} <= set(got.columns)
    assert pairs_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == sorted(brute.dedup_lines(rows_of(docs)), key=repr)


def test_runs_are_compacted(spark):
    runs = LineRuns(spark, buckets=2, fanout=2)
    for i in range(5):
        part = brute.documents(spark, [(i, f"line of everyone\nline of number {i}")])
        assert runs.dedup(part).first()["n_dropped"] == (1 if i else 0)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs._runs().count() == 6


def test_remove_repeats_equals_plain(spark):
    passage = prose(30)
    texts = [
        passage, "a" * 90, prose(20) + passage[:130] + prose(20), prose(9) + passage[5:145], passage + "é" + passage, None, "", "short",
        prose(300), (6, prose(15)), (None, passage[20:]), "b" + "a" * 61,
    ]
    texts += [texts[8][:400] + "|" + texts[8][401:], (6, texts[9][1]), texts[2]]
    docs = brute.documents(spark, texts)
    got = [
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
        for r in remove_repeats(docs, Threshold(window=60, gram=15)).collect()
    ]
    assert sorted(got, key=repr) == sorted(brute.remove_repeats(rows_of(docs), 60), key=repr)


def test_remove_repeats_in_pieces(spark, monkeypatch):
    from tidemark.llm import suffix_dedup

    limit = Threshold(window=40, gram=10)
    passage = prose(60)
    texts = [prose(50) + passage, passage + prose(30), prose(70)]
    whole = {(int(h), int(g)) for *_, h, g in zip(*suffix_dedup.runs([t.encode() for t in texts], limit))}
    monkeypatch.setattr(suffix_dedup, "PIECE", 128)
    pieces = list(suffix_dedup._pieces(((i, t.encode()) for i, t in enumerate(texts)), 40))
    windows = sum(max(0, len(p) - 39) for _, _, parts in pieces for p in parts)
    assert len(pieces) > 3 and windows == sum(len(t) - 39 for t in texts) and whole


def test_ppm_is_exact():
    texts = {"a": ["the cat sat on the mat", "the the"], "b": ["der Hund über die Ähre", "und der"]}
    languages, order = sorted(texts), 3
    grams = {}
    for i, lang in enumerate(languages):
        sizes, values, counts = count_grams(texts[lang], order)
        grams.update({(i, n): (values[sizes == n], counts[sizes == n]) for n in range(1, order + 2)})
    model = PpmModel(Counts(languages, order, grams))
    for text in ["", "t", "the", "die Katze", "qqq\x00 zebra the über", "the cat " * 50]:
        want = [brute.Ppm(texts[lang], order).bits(text) for lang in languages]
        assert np.allclose(model.code_lengths([text.encode()])[0], want)
    assert model.predict([None, "the mat", "Hund und"])[0] == ["und", "a", "b"]


def test_language_of_held_out_documents(spark):
    words = {"en": "the of and with shore ring".split(), "fr": "été où les des mère à".split()}
    rows = [(i, " ".join(RANDOM.choices(words[lang], k=12)), lang, "s", 0) for i in range(60) for lang in [("en", "fr")[i % 2]]]
    rows += [(100, None, "en", "s", 0), (101, "12 34 ...", "fr", "s", 0), (102, "été les", None, "s", 0), (103, "the and", "xx", "s", 0), (None, "the", "zz", "s", 0)]
    docs = spark.createDataFrame([(*r, "kept", "kept") for r in rows], brute.DOCS + ", lang_pred string, h int".replace("h int", "h string"))
    got = {r["doc_id"]: r for r in identify_language(docs).collect()}
    for doc_id, _, lang, _, _ in rows[:60]:
        assert got[doc_id]["lang_pred"] == lang and got[doc_id]["held_out"] == brute.held_out(doc_id)
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und", "und", "fr"] and got[100]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_learns_and_leaves_out(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(30) + (" stupid oaf " if bad else " ") + prose(10)
        rows.append((i, text))
        labels.append((i, 1, int(bad) if not brute.held_out(i) else 1 - int(bad)))  # held-out labels lie
    docs = brute.documents(spark, [*rows, (1000, None), (1001, ""), (1002, prose(5000)), (None, "x")])
    table = spark.createDataFrame([*labels, (7, 1, None), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity(docs, table, how=Ftrl(l1=1.0)).collect()}
    right = [got[i]["predicted"] == int(i % 4 == 0) for i in range(400)]
    assert sum(right) >= 380 and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[1000]["predicted"] == got[1001]["predicted"] == 0
    assert [got[i]["held_out"] for i in range(400)] == [brute.held_out(i) for i in range(400)]
    none = toxicity(docs, table.where("false")).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]


def test_alignment_equals_plain():
    for _ in range(40):
        a = [RANDOM.randrange(6) for _ in range(RANDOM.randrange(1, 12))]
        b = [RANDOM.randrange(6) for _ in range(RANDOM.randrange(0, 20))]
        assert align(np.array(a), np.array(b, dtype=int))[0] == brute.smith_waterman(a, b)


def test_leaks_exact_edited_and_none(spark):
    items = [prose(40, 3000) for _ in range(5)]
    words = items[0].split()
    changed = " ".join("changed" if i % 6 == 0 else w for i, w in enumerate(words))
    texts = [
        prose(50, 3000) + " " + items[0].upper() + ". " + prose(50, 3000), prose(2000, 3000) + " " + changed, prose(100, 3000), None, "",
        " ".join(words[:12]) + " " + prose(30, 3000), items[3] + " " + prose(500, 3000) + " " + items[3], (None, items[4]), (6, items[1]), "tiny item",
    ]
    docs = brute.documents(spark, texts)
    table = spark.createDataFrame(
        [*enumerate(items), (10, None), (11, ""), (12, "tiny item"), (13, items[1])], "item_id long, text string"
    )
    got = find_leaks(docs, table).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert found == {(0, 0), (1, 0), (6, 3), (None, 4), (6, 1), (6, 13), (9, 12)} and len(got) == len(found)
    spans = {(r["doc_id"], r["item_id"]): r for r in got}
    assert spans[0, 0]["score"] == 1.0 and (spans[0, 0]["first_word"], spans[0, 0]["end_word"]) == (50, 90)
    assert 0.6 < spans[1, 0]["score"] < 0.9 and spans[1, 0]["end_word"] == 2040
    assert find_leaks(docs, table.where("false")).count() == 0
