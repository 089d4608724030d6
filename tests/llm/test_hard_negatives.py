"""Hard negatives against loops over all rows, and the tree and its bounds by themselves."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from tradeloom.llm.hard_negatives import Scores, best_of, edge_lengths, mine_hard_negatives, spanning_tree, walk, walk_order, window
from tradeloom.llm.queries import op12_hard_negatives


def plain(rows, is_anchor, positives=5, negatives=3):
    """(id, label, vector) to the result, by loops with Python's whole numbers."""
    rows = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows]
    out = set()
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i and len(w) == len(v)]
        scored.sort()
        for positive, p, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [s for s in scored if s[2] != label and 50 * -positive <= 100 * -s[0] <= 95 * -positive]
            out |= {(i, p, rank, n, -positive, -negative) for rank, (negative, n, _) in enumerate(hard[:negatives], 1)}
    return out


def clustered(dice, rows, size=12, labels=4, noise=0.05):
    """Vectors around a few directions, so that many scores fall into windows and bounds prune."""
    centers = dice.normal(size=(6, size))
    which = dice.integers(0, 6, rows)
    x = centers[which] * 0.3 + dice.normal(scale=noise, size=(rows, size))
    return [(int(i), int((which[i] + (dice.random() < 0.3)) % labels), [float(v) for v in x[i].astype(np.float32)]) for i in range(rows)]


def test_tree_is_minimal():
    points = np.random.default_rng(1).integers(-50, 50, (60, 3))
    parent = spanning_tree(points)
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    inside, total = {0}, 0.0  # Prim's rule by loops
    while len(inside) < 60:
        gap, point = min((gaps[i, j], j) for i in inside for j in range(60) if j not in inside)
        inside.add(point)
        total += gap
    assert sum(gaps[i, p] for i, p in enumerate(parent) if p >= 0) == pytest.approx(total)
    assert (edge_lengths(points, parent)[1:] >= gaps[np.arange(1, 60), parent[1:]]).all()


def test_walk_frees_parents():
    for parent in ([-1], [-1, *range(200)], [-1] + [0] * 200, spanning_tree(np.random.default_rng(2).integers(0, 9, (300, 2)))):
        parent = np.array(parent)
        held, most = set(), 0
        order = walk_order(parent)
        assert sorted(p for p, _ in order) == list(range(len(parent)))
        for point, last in order:
            if parent[point] >= 0:
                assert parent[point] in held
                if last:
                    held.discard(parent[point])
            held.add(point)
            most = max(most, len([p for p in held if (parent == p).any()]))
        assert most <= math.log2(len(parent)) + 2


def test_bounds_hold_and_prune():
    dice = np.random.default_rng(3)
    x = np.array([v for _, _, v in clustered(dice, 2000, noise=0.02)])
    x = np.floor(256 * x).astype(np.int64)
    anchors, candidates = x[:100], x[100:]
    truth = anchors @ candidates.T
    scored = 0

    def wanted(point, low, high):
        assert (low <= truth[point]).all() and (truth[point] <= high).all()
        return (high >= 8000) & (low <= 9000)

    scores = Scores(candidates, int(np.abs(anchors).max()))
    for point, picked, found in walk(anchors, spanning_tree(anchors), scores, wanted):
        assert (found == truth[point, picked]).all()
        inside = np.flatnonzero((truth[point] >= 8000) & (truth[point] <= 9000))
        assert np.isin(inside, picked).all()
        scored += len(picked)
    assert scored < 0.5 * truth.size


def test_large_numbers_stay_exact():
    candidates = np.array([[1 << 29, 1], [(1 << 29) - 1, 3]])
    anchor = np.array([[1 << 29, 1]])
    scores = Scores(candidates, 1 << 29)
    assert scores.kind == np.int64
    assert scores.of(anchor[0], np.array([0, 1])).tolist() == [(1 << 58) + 1, (1 << 29) * ((1 << 29) - 1) + 3]


def test_windows_and_best():
    for positive in range(-40, 400):
        low, high = window(positive, 50, 95)
        fits = [n for n in range(-500, 500) if 50 * positive <= 100 * n <= 95 * positive]
        assert fits == list(range(low, high + 1))
    assert best_of(np.array([5, 7, 7, 1, 7]), np.array([1, 9, 3, 2, 4]), 2).tolist() == [2, 4]
    assert best_of(np.zeros(0, np.int64), np.zeros(0, np.int64), 3).tolist() == []


def results(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("blocks", [(8192, 32_768), (7, 60)])
def test_equals_loops(spark, blocks):
    rows = clustered(np.random.default_rng(4), 700)
    rows += [(1000 + i, 2, rows[5][2]) for i in range(200)]  # a hot vector, all of its scores tied
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(6)
    found = mine_hard_negatives(table, F.col("vec_id") % 11 == 0, anchor_rows=blocks[0], candidate_rows=blocks[1])
    expected = plain(rows, lambda i: i % 11 == 0)
    assert results(found) == expected and len(expected) > 500


def test_query_equals_loops(spark):
    directory = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
        for r in spark.read.parquet(f"{directory}/embeddings.parquet").collect()
    ]
    assert results(op12_hard_negatives(spark, directory)) == plain(rows, lambda i: i % 50 == 0)


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.75, 0.0]), (3, 2, [0.75, 1.0]), (4, 2, [0.0, 1.0]), (5, 1, [0.0, 0.0]), (6, 3, [-1.0, 0.0])]
    odd = [
        (50, 1, None), (100, None, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (150, 1, [nan, 0.0]), (7, 2, [inf, 0.6]), (8, 2, [None, 0.6]),
        (9, 2, [0.7, 0.0, 0.0]), (200, 1, []), (10, 2, [1e30, 0.0]),
    ]
    schema = "vec_id bigint, label int, embedding array<double>, rank int"
    table = spark.createDataFrame([(*r, 1) for r in good * 2 + odd], schema)
    found = results(mine_hard_negatives(table, F.col("vec_id") % 50 == 0))
    assert found == plain(good, lambda i: i % 50 == 0) and found
    # Rows of one id that differ: neither is the other's positive or negative.
    twice = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.25]), (0, 2, [0.75, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.0])]
    found = mine_hard_negatives(spark.createDataFrame([(*r, 1) for r in twice], schema), F.col("vec_id") % 50 == 0)
    assert set(map(tuple, found.collect())) == {r for row in twice[:3] for r in plain([row, *twice[3:]], lambda i: i == 0)}
    assert results(mine_hard_negatives(table.limit(0), F.col("vec_id") % 50 == 0)) == set()
    assert results(mine_hard_negatives(table, F.col("vec_id") < 0)) == set()
