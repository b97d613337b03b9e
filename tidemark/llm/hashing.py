"""Word and shingle hashes of many texts at once, in numpy.

A word's hash is a polynomial over 64-bit values drawn for its bytes, computed from
prefix sums over a piece of text, then mixed. Pieces end at a space and hold about
``PIECE`` bytes, so memory does not grow with a text beyond the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

PIECE = 1 << 17
CHUNK = 1 << 16
# The mixing constants of the splitmix64 generator, and an odd base.
MIX_1, MIX_2, GOLDEN = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
BASE = 0x5851F42D4C957F2D

_u = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x + _u(GOLDEN)
    x = (x ^ (x >> _u(30))) * _u(MIX_1)
    x = (x ^ (x >> _u(27))) * _u(MIX_2)
    return x ^ (x >> _u(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _u(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BYTE = mixed(np.arange(256, dtype=np.uint64))
_WORD_BYTE = BYTE[FOLD]
_WORD_BYTE[SPACE] = 0
_INSIDE = (~SPACE).astype(np.uint8).tobytes()
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    size = max(_tables, default=0)
    if size < n:
        size = max(2 * PIECE, 1 << (n - 1).bit_length())
        _tables.clear()
        _tables[size] = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
    return _tables[size]


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Joined text of about PIECE bytes each, with (index of the text, end in the piece)."""
    parts: list[bytes] = []
    ends: list[tuple[int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while True:
            stop = len(data)
            if stop - at > PIECE:
                found = max((data.rfind(s, at, at + PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")), default=-1)
                if found < 0:
                    later = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := data.find(s, at)) >= 0]
                    found = min(later, default=stop - 1)
                stop = found + 1
            parts.append(data[at:stop])
            size += stop - at + 1
            ends.append((i, size))
            at = stop
            if size >= PIECE:
                yield b"\n".join(parts) + b"\n", ends
                parts, ends, size = [], [], 0
            if at >= len(data):
                break
    if ends:
        yield b"\n".join(parts) + b"\n", ends


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words of each text.

    Words are runs without spaces, A-Z lower-cased.
    """
    counts = np.zeros(len(texts), dtype=np.int64)
    found = [np.zeros(0, dtype=np.uint64)]
    for data, ends in _pieces(texts):
        raw = np.frombuffer(data, dtype=np.uint8)
        power, inverse = powers(len(raw))
        inside = np.frombuffer(data.translate(_INSIDE), dtype=bool)
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate(([0], edge))
        start, stop = edge[0::2], edge[1::2]
        sums = np.cumsum(np.take(_WORD_BYTE, raw, mode="clip") * power[: len(raw)], dtype=np.uint64)
        upto = sums[stop - 1]
        before = np.where(start > 0, sums[start - 1], _u(0))
        found.append(mixed((upto - before) * inverse[start] + (stop - start).astype(np.uint64)))
        index, end = np.array(ends, dtype=np.int64).T
        np.add.at(counts, index, np.diff(np.searchsorted(start, end), prepend=0))
    return np.concatenate(found), counts


def offsets(counts: np.ndarray) -> np.ndarray:
    """Where each text's values begin, and the end of the last."""
    return np.concatenate(([0], np.cumsum(counts)))


def chained(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words; as many as there are full runs."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for at in range(0, n, CHUNK):
        part = out[at : at + CHUNK]
        for k in range(1, width):
            part[:] = mixed(part * _u(GOLDEN) + words[at + k : at + k + len(part)])
    return out


def different(values: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    values = np.sort(values)
    fresh = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def shingle_sets(texts: Sequence[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text.

    A text with fewer words than ``width`` has its whole sequence as one shingle, one
    without words the empty set.
    """
    words, counts = word_hashes(texts)
    at = offsets(counts)
    runs = chained(words, width)
    sets = []
    for i, n in enumerate(counts.tolist()):
        if n >= width:
            sets.append(different(runs[at[i] : at[i] + n - width + 1]))
        elif n:
            sets.append(chained(words[at[i] : at[i + 1]], n) + _u(n))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
