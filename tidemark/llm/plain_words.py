"""Hashes of plain words: runs of letters and digits, whatever stands between them.

Letters are lower-cased; characters of scripts that are written without spaces are
words of their own. A table over all code points says for each which value it adds to
its word's hash, none if it belongs to no word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import regex

from tidemark.llm.hashing import mixed, powers

PIECE = 1 << 19
CODE_POINTS = 0x110000
SURROGATES = range(0xD800, 0xE000)
# Scripts written without spaces between words.
UNSPACED = "Han Hiragana Katakana Bopomofo Thai Lao Khmer Myanmar".split()

_u = np.uint64


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its value, 0 outside words, and whether it is a word of its own."""
    known = "".join(chr(c) for c in range(CODE_POINTS) if c not in SURROGATES)

    def members(pattern: str) -> np.ndarray:
        out = np.zeros(CODE_POINTS, dtype=bool)
        for m in regex.finditer(f"(?:{pattern})+", known):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = True
        out[SURROGATES.start : SURROGATES.stop] = False
        return out

    inside = members(r"[\p{L}\p{N}]")
    lower = np.arange(CODE_POINTS, dtype=np.uint64)
    changed = [(ord(c), ord(c.lower()[0])) for c in known if c.lower() != c]
    lower[[c for c, _ in changed]] = [low for _, low in changed]
    alone = inside & members("[" + "".join(rf"\p{{{s}}}" for s in UNSPACED) + "]")
    return np.where(inside, mixed(lower + _u(1 << 32)) | _u(1), _u(0)), alone


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Joined text of about PIECE characters, with (index of the text, end in the piece); long texts end at a space."""
    parts: list[str] = []
    ends: list[tuple[int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        text, at = text or "", 0
        while True:
            stop = len(text)
            if stop - at > PIECE:
                space = text.find(" ", at + PIECE)
                stop = space + 1 if space >= 0 else stop
            parts.append(text[at:stop])
            size += stop - at + 1
            ends.append((i, size))
            at = stop
            if size >= PIECE:
                yield "\n".join(parts) + "\n", ends
                parts, ends, size = [], [], 0
            if at >= len(text):
                break
    if ends:
        yield "\n".join(parts) + "\n", ends


def plain_word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every plain word, and the number of words of each text. A null text has none."""
    value, alone = _tables()
    counts = np.zeros(len(texts), dtype=np.int64)
    found = [np.zeros(0, dtype=np.uint64)]
    for joined, ends in _pieces(texts):
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        own, single = value[raw], alone[raw]
        inside = own != 0
        # A word goes on only between two characters that are no words of their own.
        joins = inside[1:] & inside[:-1]
        if single.any():
            joins &= ~(single[1:] | single[:-1])
        start = np.flatnonzero(inside & ~np.concatenate(([False], joins)))
        stop = np.flatnonzero(inside & ~np.append(joins, False))
        power, inverse = powers(len(raw))
        sums = np.cumsum(own * power[: len(raw)], dtype=np.uint64)
        before = sums[start] - own[start] * power[start]
        found.append(mixed((sums[stop] - before) * inverse[start] + (stop - start + 1).astype(np.uint64)))
        index, end = np.array(ends, dtype=np.int64).T
        np.add.at(counts, index, np.diff(np.searchsorted(start, end), prepend=0))
    return np.concatenate(found), counts
