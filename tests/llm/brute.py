"""Plain versions of the operators, for small inputs, and input rows for all tests."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as extra columns.
CLASHING = "id long, size long, set long, text_hash long, first long, rank int, held_out string, n_lines string, h int, k1 int"
SPACES = " \t\n\x0b\x0c\r"


def documents(spark, texts, sources=None):
    """Documents 0, 1, ... with the given texts; a pair gives the id too."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (i, text)
        source = sources[i] if sources else f"s{i % 3}"
        rows.append((doc_id, text, "en", source, len(text or "")) + (7, 7, 7, 7, 7, 7, "x", "x", 7, 7))
    return spark.createDataFrame(rows, f"{DOCS}, {CLASHING}").repartition(3)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_duplicates(rows, percent=75):
    """(doc_id, set size, smallest id reachable) of each row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def dedup_lines(rows, least=10):
    """(doc_id, lines, dropped, kept text) of each row."""
    number = lambda d: float("inf") if d is None else d
    key = lambda line: lower(line.strip(SPACES))
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), number(d)), number(d))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] >= number(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def remove_repeats(rows, window):
    """(doc_id, bytes, removed, spans, kept hash) of each row."""
    data = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + window] for _, b in data for i in range(len(b) - window + 1))
    out = []
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def top_k(rows, k=5, every=50):
    """(query, rank, id, score); one row per id."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for q, v in rows:
        if q % every == 0:
            best = sorted((-score(v, w), c) for c, w in rows if c != q)[:k]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(best, 1)]
    return out


def smith_waterman(a, b, match=2, mismatch=-1, gap=-1):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (match if x == y else mismatch), row[j + 1] + gap, new[j] + gap))
        best, row = max(best, *new), new
    return best


class Ppm:
    """Byte contexts with escapes (method C), straight from the definition."""

    def __init__(self, texts, order):
        self.order = order
        self.seen = defaultdict(Counter)
        for text in texts:
            b = text.encode()
            for i in range(len(b)):
                for n in range(min(order, i) + 1):
                    self.seen[b[i - n : i]][b[i]] += 1

    def bits(self, text):
        from math import log2

        b, total = text.encode(), 0.0
        for i in range(len(b)):
            for n in range(min(self.order, i), -1, -1):
                followers = self.seen.get(b[i - n : i])
                if followers is None:
                    continue
                whole = sum(followers.values()) + len(followers)
                if b[i] in followers:
                    total += log2(whole / followers[b[i]])
                    break
                total += log2(whole / len(followers))
            else:
                total += 8.0
        return total


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
