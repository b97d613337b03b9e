"""Language identification with texts shorter than a context."""

import numpy as np
import pytest

import llm.brute as brute
from tidemark.llm.language import count_grams, identify_language


@pytest.mark.parametrize("length", range(7))
@pytest.mark.parametrize("order", range(5))
def test_grams_of_short_texts_are_counted(length, order):
    sizes, grams, counts = count_grams(["abcdef"[:length], "ab"], order)
    want = {}
    for text in ("abcdef"[:length].encode(), b"ab"):
        for n in range(1, order + 2):
            for i in range(len(text) - n + 1):
                key = n, int.from_bytes(text[i : i + n], "big")
                want[key] = want.get(key, 0) + 1
    assert dict(zip(zip(sizes.tolist(), grams.tolist()), counts.tolist())) == want
    assert counts.dtype.kind in "iu" and grams.dtype == np.uint64


def test_short_and_long_texts_are_judged(spark):
    texts = ["abcdef"[:n] for n in range(7)] + ["é", "日本", "the cat " * 40_000, None]
    got = {r["doc_id"]: r["lang_pred"] for r in identify_language(brute.documents(spark, texts)).collect()}
    assert got == {i: "en" if t else "und" for i, t in enumerate(texts)}
