"""Near copies of vectors and hard negatives against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import metric_join, multi_index
from tidemark.llm.metric_join import Cells, near_vectors, roots, spread_pivots
from tidemark.llm.multi_index import MultiIndex, hard_negatives, walk
from tidemark.llm.pivot_search import top_k_products
from tidemark.llm.queries import relabelled

# Names that the operators use inside, as extra columns.
KIND = "vec_id long, embedding array<float>, label int, id long, v string, row int, weight int, cell int, anchor string, k1 int, score int, rank string"
EXTRA = (7, "x", 7, 7, 7, "x", 7, 7, "x")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label) + EXTRA for i, v, label in rows], KIND).repartition(3)


def awkward(n=260, width=6, seed=1):
    """Groups of copies, chains of near ones, and rows with nulls, zeros and other widths."""
    chance = random.Random(seed)
    centres = [[chance.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    rows = []
    for i in range(n):
        c = centres[min(i % 14, 8)]
        spread = chance.choice([0.0, 0.03, 0.06, 0.1, 0.3])
        rows.append((i, [x + chance.gauss(0, spread) for x in c], chance.choice([0, 1, 1, 1, 2, None])))
    nan, inf = float("nan"), float("inf")
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * width, 1), (n + 3, [nan] * width, 1), (n + 4, [inf] + [1.0] * (width - 1), 1), (n + 5, [None] + [1.0] * (width - 1), 1)]
    rows += [(n + 6, centres[8][:4], 1), (n + 7, centres[8][:4] + [0.0] * (width - 4), 1), (None, centres[8], 1), (None, [9.0] + [0.0] * (width - 1), 2), (3, centres[8], 1), (3, centres[8], 1), (3, centres[0], 2)]
    rows += [(n + 8, [1e30 * x for x in centres[8]], 1), (n + 9, [1e-30 * x for x in centres[8]], 1), (-100, centres[8], 1), (0, centres[7], 2)]
    return rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_near(rows, least=0.98):
    rows = [(i, v, label) for i, v, label in rows]
    width = max((len(v) for _, v, _ in rows if v), default=1)
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and usable(v) and any(v)]
    m = {k: np.array(list(np.float64(np.float32(rows[k][1]))) + [0.0] * (width - len(rows[k][1]))) for k in good}
    near = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2]:
                x, y = m[a] / np.abs(m[a]).max(), m[b] / np.abs(m[b]).max()
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                    near[a].add(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for b in near[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        first = min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)
        out.append((i, len(near[k]), first, i is not None and i == first))
    return sorted(out, key=repr)


def plain_negatives(rows, every=100):
    good = [(i, [math.floor(float(np.float32(x)) * 256) for x in v], label) for i, v, label in rows if i is not None and label is not None and usable(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (i, v, label) in enumerate(good):
        if i % every:
            continue
        scores = [(-dot(v, w), j, other) for b, (j, w, other) in enumerate(good) if a != b]
        for p, j, _ in sorted(s for s in scores if s[2] == label)[:5]:
            fits = sorted((n, k) for n, k, other in scores if other != label and 30 * -p <= 100 * -n <= 90 * -p)[:10]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(fits, 1)]
    return sorted(out)


@pytest.fixture
def small_blocks(monkeypatch):
    """Many blocks, cells and rounds for few rows."""
    for module, name, value in (
        (metric_join, "BLOCK_ROWS", 8), (metric_join, "ROWS_PER_PIVOT", 16), (metric_join, "STRIPE_ROWS", 3), (metric_join, "BROADCAST_ROWS", 0),
        (multi_index, "BLOCK_ROWS", 8), (multi_index, "TILE_ROWS", 2), (multi_index, "FIRST_CELLS", 2), (multi_index, "GROWTH", 3),
    ):
        monkeypatch.setattr(module, name, value)


@pytest.mark.parametrize("least", [0.98, 0.9])
def test_near_vectors_equal_plain_ones(spark, small_blocks, least):
    rows = awkward()
    got = near_vectors(frame(spark, rows), least)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_near(rows, least)


def test_near_vectors_of_few_rows(spark):
    rows = awkward(40, 3, 4)
    assert sorted(map(tuple, near_vectors(frame(spark, rows)).collect()), key=repr) == plain_near(rows)
    assert near_vectors(frame(spark, rows).where("false")).count() == 0
    assert sorted(map(tuple, near_vectors(frame(spark, [(5, None, None), (5, [], 1)])).collect())) == [(5, 0, 5, True)] * 2


def test_large_group_of_copies_makes_few_rows(spark):
    chance = np.random.default_rng(2)
    centre = chance.normal(size=16)
    rows = [(i, (centre + chance.normal(size=16) * 0.02).tolist(), 1) for i in range(900)] + [(i, centre.tolist(), 1) for i in range(900, 1500)]
    got = near_vectors(frame(spark, rows)).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(1499, 0)}
    classes = spark.createDataFrame([(i, "1", v, 1, i, i, i) for i, v, _ in rows[:900]], "vector long, label string, v array<double>, weight long, first long, k1 long, k2 long")
    assert metric_join._found(classes, 0.98).count() == 900


def test_visitors_cover_all_links():
    chance = np.random.default_rng(3)
    units = chance.normal(size=(500, 4))
    units /= np.sqrt((units**2).sum(axis=1))[:, None]
    reach = math.sqrt(2 - 2 * 0.9)
    bare = Cells(spread_pivots(units, 12, reach), reach)
    away = bare.distances(units)
    home = away.argmin(axis=1)
    span = [away[home == p, p] for p in range(len(bare.pivots))]
    cells = Cells(bare.pivots, reach, np.array([s.min(initial=np.inf) for s in span]), np.array([s.max(initial=-np.inf) for s in span]))
    there = cells.visits(home, away)
    assert there.sum() < there.size / 3
    for a, b in zip(*np.nonzero(units @ units.T >= 0.9)):
        assert home[a] == home[b] or there[a, home[b]] or there[b, home[a]]
        shared = home[b] if there[a, home[b]] else home[a]
        assert abs(int(cells.ring(away[a, shared])) - int(cells.ring(away[b, shared]))) <= 1


def test_roots_follow_chains():
    links = np.eye(6, dtype=bool)
    for a, b in [(0, 1), (1, 2), (2, 3), (4, 5)]:
        links[a, b] = links[b, a] = True
    assert roots(links)[0].tolist() == [0, 0, 0, 0, 4, 4]


def test_walk_visits_cells_by_falling_bound():
    chance = np.random.default_rng(4)
    first, second = chance.normal(size=9), chance.normal(size=7)
    filled = {(int(i), int(j)) for i, j in chance.integers(0, 7, (40, 2))}
    got = list(walk(first, second, filled))
    assert [b for b, _, _ in got] == sorted((first[i] + second[j] for i, j in filled), reverse=True)
    assert {(i, j) for _, i, j in got} == filled


def test_certified_windows_stop_the_walk():
    codes = (np.array([[10.0], [0.0], [-10.0]]), np.array([[10.0], [0.0], [-10.0]]))
    filled = frozenset((i, j) for i in range(3) for j in range(3))
    index = MultiIndex(codes, (np.full(3, 1.0), np.full(3, 1.0)), filled)
    anchor = np.array([10, 10])
    assert index.wanted(anchor, [(-10**6, 10**6, 170)], 0, 100) == ([(0, 0)], False)
    assert index.wanted(anchor, [(-10**6, 10**6, -10**6)], 0, 2) == ([(0, 0), (0, 1)], True)
    # Cells above the window are passed over, those below end the walk.
    assert index.wanted(anchor, [(-5, 5, -10**6)], 0, 100)[0] == [(0, 2), (1, 1), (2, 0)]
    assert index.wanted(anchor, [(5, -5, 0)], 0, 100) == ([], False)


@pytest.mark.parametrize("every", [100, 10])
def test_hard_negatives_equal_plain_ones(spark, small_blocks, every):
    rows = [r for r in awkward() if r[1] is None or not any(x is not None and abs(x) > 1e9 and math.isfinite(x) for x in r[1])]
    got = hard_negatives(frame(spark, rows), every=every)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, every)
    assert hard_negatives(frame(spark, rows).where("false")).count() == 0
    assert hard_negatives(frame(spark, [(0, [1.0], 1), (1, [1.0, 2.0], 2)])).count() == 0


def test_relabelled_rows(spark):
    rows = [(0, [1.0], 9), (7, [1.0], None), (8, [1.0], 9), (None, [1.0], 3)]
    assert sorted(((r["vec_id"], r["label"]) for r in relabelled(frame(spark, rows)).collect()), key=repr) == [(0, 0), (7, None), (8, 9), (None, 3)]


def test_top_products_of_repeated_ids(spark):
    """Rows of one id are rows of their own, and candidates of each other."""
    rows = [r for r in awkward(90) if r[1] is None or not any(x is not None and math.isfinite(x) and abs(x) > 1e9 for x in r[1])]
    rows += [(50, [0.1] * 6, 1), (50, [0.9] * 6, 1), (50, [0.9] * 6, 2), (7, [0.9] * 6, 2), (7, [0.1] * 6, 2)]
    good = [(i, [math.floor(float(np.float32(x)) * 256) for x in v]) for i, v, _ in rows if i is not None and usable(v)]
    want = []
    for a, (i, v) in enumerate(good):
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(good) if a != b)
            want += [(i, rank, j, -p) for rank, (p, j) in enumerate(scores[:5], 1)]
    assert sorted(map(tuple, top_k_products(frame(spark, rows), pivots=3).collect())) == sorted(want)
