"""Hard negatives against all pairs, the tree's bounds, and edges."""

import random

import numpy as np
import pytest

from llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, weights string, centre string, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "w", "c", "s") for r in rows], SCHEMA)


def brute(rows):
    sound = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        sound.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, whole))
    out = []
    anchors = {}
    for vec_id, label, whole in sorted(sound):
        if vec_id % 50 == 0:
            anchors.setdefault(vec_id, (label, whole))
    for anchor, (label, whole) in anchors.items():
        scored = [(sum(x * y for x, y in zip(whole, w)), i, k) for i, k, w in sound if i != anchor]
        near = sorted((-s, i) for s, i, k in scored if k == label)[:5]
        for place, (score, positive) in enumerate(near, 1):
            inside = [(-s, i) for s, i, k in scored if k != label and 50 * -score <= 100 * s <= 95 * -score]
            for rank, (s, i) in enumerate(sorted(inside)[:3], 1):
                out.append((anchor, positive, rank, i, -score, -s, place))
    return sorted(out)


def mined(spark, rows):
    return sorted(tuple(r) for r in hn.mine(vectors(spark, rows)).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(700):
        vector = (centres[i % 6] + rng.normal(size=8) * 0.3) * rng.choice([0.2, 1, 3])
        rows.append((i, [float(np.float32(x)) for x in vector], int(rng.integers(0, 4))))
    same = [(1000 + i, rows[3][1], i % 3) for i in range(90)]
    odd = [(None, [1.0], 1), (2000, None, 1), (2050, [1.0, None], 1), (2100, [float("nan")], 1), (2150, [1.0], None)]
    short = [(2200, [], 2), (2201, [0.5], 2), (2250, [0.5, -0.25], 1), (100, rows[100][1], 3), (101, rows[101][1], 0)]
    return [*rows, *same, *odd, *short, (-50, rows[5][1], -3), (-49, rows[5][1], -3)]


def test_matches_all_pairs(spark, rows):
    assert mined(spark, rows) == brute(rows)


def test_many_cells_and_small_leaves_change_nothing(spark, rows, monkeypatch):
    for name, value in (("SAMPLE", 40), ("ROWS_PER_CENTRE", 60), ("CELL_ROWS", 50)):
        monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows) == brute(rows)


def test_deep_trees_find_what_all_pairs_find_and_score_less(monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 8)
    monkeypatch.setattr(hn, "FAN_OUT", 4)
    rng = np.random.default_rng(4)
    middles = rng.integers(-200, 200, (20, 6))
    points = middles[np.arange(1200) % 20] + rng.integers(-6, 7, (1200, 6))
    labels, ids = np.arange(1200) % 3, np.arange(1200)[::-1].copy()
    low, high = np.full((30, 1), 10_000), np.full((30, 1), 60_000)
    bar = np.full((30, 1), np.iinfo(np.int64).min)
    wanted = hn.Wanted(ids[:30], labels[:30], points[:30], low, high, False, 3, bar)
    search = hn.Search(wanted, ids, labels, points, float(hn.squares(points).max()))
    who, _, score, row = search.run()
    for anchor in range(30):
        every = points @ points[anchor]
        fits = (labels != labels[anchor]) & (every >= 10_000) & (every <= 60_000)
        best = sorted((-every[i], ids[i]) for i in np.flatnonzero(fits))[:3]
        assert [(-s, ids[r]) for s, r in zip(score[who == anchor], row[who == anchor])] == best
    assert search.scored < 0.5 * 30 * 1200


def test_radii_cover_and_bounds_hold():
    rng = np.random.default_rng(9)
    points = rng.integers(-90, 90, (900, 5))
    space = hn.Space(points, float(hn.squares(points).max()))
    stack = [hn.cover_tree(space, np.zeros(900, np.int64))]
    seen = np.zeros(900, np.int64)
    queries = rng.integers(-300, 300, (7, 5))
    while stack:
        node = stack.pop()
        assert space.distances(node.rows, node.centre).max() <= node.radius + 1e-6
        own = hn.squares(queries)
        least, greatest = hn.bounds((queries @ points[node.centre]).astype(float), own, space.most, node.radius)
        scores = queries @ points[node.rows].T
        assert (scores.max(axis=1) <= greatest).all() and (scores.min(axis=1) >= least).all()
        stack += node.children
        if not node.children:
            seen[node.rows] += 1
    assert (seen == 1).all()


def test_products_are_exact():
    big = np.array([[2**40, 3, -(2**40)]])
    assert hn.products(big, np.array([[5, 2**41, 1]]))[0, 0] == 5 * 2**40 + 3 * 2**41 - 2**40


def test_tables_without_anchors_or_rows(spark):
    assert mined(spark, []) == []
    rng = random.Random(1)
    assert mined(spark, [(i, [rng.random(), rng.random()], i % 2) for i in range(1, 40)]) == []
    assert mined(spark, [(50, [1.0], 0)]) == []
