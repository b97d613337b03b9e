"""Signatures and groups that very many sets share."""

from __future__ import annotations

import llm.brute as brute
import numpy as np
import pytest
from llm.test_text_operators import edited, pairs_of, prose, rows_of
from tidemark.llm import jaccard
from tidemark.llm.jaccard import Bands, _candidates, _hot, _met, _placed, _tile_pairs, near_duplicates


@pytest.mark.parametrize("large", [3, 64])
def test_hot_signatures_give_the_same_links(spark, monkeypatch, large):
    monkeypatch.setattr(jaccard, "HOT_SETS", 3)
    monkeypatch.setattr(jaccard, "HOT_LEAST", 3)
    monkeypatch.setattr(jaccard, "LARGE_GROUP", large)
    monkeypatch.setattr(jaccard, "TILE_SETS", 2)
    texts = [edited([i]) for i in range(0, 60, 2)] + [edited(range(i)) for i in range(0, 60, 5)] + [prose(n) for n in (40, 90)] + [None, "one"]
    docs = brute.documents(spark, texts)
    got = pairs_of(near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_duplicates(rows_of(docs)), key=repr)


def test_a_hot_signature_is_dealt_out_by_set(spark, monkeypatch):
    """Its sets are plain rows; without the list of hot ones it gives the same groups, and each has a pair of a first set and each other."""
    monkeypatch.setattr(jaccard, "HOT_SETS", 10)
    docs = brute.documents(spark, [edited([i]) for i in range(60)]).select("text")
    none = np.zeros(0, dtype=np.uint64)
    hot = _hot(docs, 60, 5, Bands(), none)
    found = _candidates(docs, 5, Bands(), 8, none, hot).cache()
    assert len(hot) and {tuple(r) for r in found.where("kind = 'member'").groupBy("a").count().where("count > 9").collect()} == set()
    assert found.where("kind = 'hot'").select("a").distinct().count() == len(hot)
    plain = _met(_candidates(docs, 5, Bands(), 8, none, none))
    dealt = _met(found)
    def sets(members):
        held = {}
        for r in members.collect():
            held.setdefault(r["group"], set()).add(r["node"])
        return {frozenset(x) for x in held.values()}

    assert sets(dealt[1]) == sets(plain[1])
    linked = {frozenset(p) for p in dealt[0].collect()}
    for group in sets(dealt[1]):
        assert any(all({hub, x} in linked for x in group - {hub}) for hub in group)


def test_one_outlier_meets_a_large_component_once(spark, monkeypatch):
    """As many tile pairs as tiles, not their square."""
    monkeypatch.setattr(jaccard, "TILE_SETS", 8)
    rows = [(1, n, 1 if n < 400 else n, 401) for n in range(401)]
    placed = _placed(spark.createDataFrame(rows, "group long, node long, root long, members long"))
    tiles = placed.select("tile").distinct().count()
    pairs = _tile_pairs(placed).collect()
    assert tiles > 40 and len(pairs) == tiles
    alone = placed.where("node = 400").first()["tile"]
    assert all(alone in (p["i"], p["j"]) for p in pairs)
