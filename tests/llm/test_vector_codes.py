"""Vector codes against plain loops with Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from tests.conftest import as_dicts
from tradeloom.llm.queries import op13_vector_codes
from tradeloom.llm.vector_codes import compress_vectors, nearest, pivot_distances, spread_pivots


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, label, vector) to {id: (code, error, label_error)} and the digest, by loops."""
    kept = [(i, label, [math.floor(scale * float(x)) for x in v]) for i, label, v in rows]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), at) for at, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(best(v[p], books[p])[1], []).append(v[p])
            for at, members in groups.items():
                books[p][at] = [sum(x) // len(members) for x in zip(*members)]
    found, by_label = {}, {}
    for (i, label, _), v in zip(kept, cut):
        nearest_ones = [best(v[p], books[p]) for p in range(parts)]
        error = sum(x[0] for x in nearest_ones)
        found[i] = ("".join(f"{x[1]:02x}" for x in nearest_ones), error, label)
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return {i: (code, error, by_label[label]) for i, (code, error, label) in found.items()}, digest


@pytest.mark.parametrize("spread", [2, 40, 4000])
def test_pivots_find_the_nearest_entry(spread):
    dice = np.random.default_rng(spread)
    parts = dice.integers(-spread, spread + 1, (700, 6))  # small spreads make many ties
    entries = dice.integers(-spread, spread + 1, (100, 6))
    parts[:100] = entries
    pivots = spread_pivots(entries, 8)
    index, best, evaluated = nearest(parts, pivot_distances(parts, pivots), entries, pivot_distances(pivots, entries))
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()
    assert evaluated <= every.size
    if spread == 4000:
        assert evaluated < 0.9 * every.size


def test_bounds_prune_clustered_parts():
    dice = np.random.default_rng(5)
    centers = dice.integers(-5000, 5000, (64, 8))
    parts = centers[dice.integers(0, 64, 2000)] + dice.integers(-20, 21, (2000, 8))
    pivots = spread_pivots(centers, 8)
    index, best, evaluated = nearest(parts, pivot_distances(parts, pivots), centers, pivot_distances(pivots, centers))
    assert evaluated < 0.2 * 2000 * 64
    assert (best == ((parts[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1)).all()


def test_equals_loops(spark):
    dice = np.random.default_rng(2)
    rows = [(int(i), int(i % 3) if i % 5 else None, [float(x) for x in dice.normal(scale=0.2, size=8).astype(np.float32)]) for i in dice.permutation(300)]
    rows[7:40] = [(i, label, rows[0][2]) for i, label, _ in rows[7:40]]  # a hot vector
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(5)
    for entries in (16, 256):
        coded, books = compress_vectors(table, entries=entries, pivots=3)
        expected, digest = plain(rows, entries=entries)
        assert {r.vec_id: (r.code, r.error, r.label_error) for r in coded.collect()} == expected
        assert books.digest() == digest


def test_query_equals_loops(spark):
    directory = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{directory}/embeddings.parquet").collect()]
    expected, digest = plain(rows)
    found = op13_vector_codes(spark, directory).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in found} == expected
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (4, 1, [0.5, 0.0, -0.5, 1.0], "a"), (2, 1, [0.0, 0.0, 0.0, -0.0001], "b"), (2, None, [0.25, 0.0, 0.0, 0.0], "c"), (2, None, [0.25, 0.0, 0.0, 0.0], "d"),
        (None, 2, [1.0, 1.0, 1.0, 1.0], "e"), (5, 2, None, "f"), (6, 2, [nan, 0.0, 0.0, 0.0], "g"), (7, 2, [inf, 0.0, 0.0, 0.0], "h"),
        (8, 2, [None, 0.0, 0.0, 0.0], "i"), (9, 3, [1.0, 2.0], "j"), (10, 3, [1e30, 0.0, 0.0, 0.0], "k"), (11, 4, [], "l"),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>, error string")
    coded, books = compress_vectors(table, entries=3, pivots=2)
    assert coded.columns == ["vec_id", "label", "embedding", "code", "error", "label_error"]
    found = sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in coded.collect()), key=str)
    # Entries start as the three rows of id 2 in array order. Rows are told apart here by id and vector.
    usable = [((99 if i is None else i, tuple(v)), label, v) for i, label, v, _ in rows if i in (2, 4, None) and v]
    expected, digest = plain(usable, entries=3)
    assert books.digest() == digest
    coded_rows = {(99 if r.vec_id is None else r.vec_id, tuple(r.embedding)): (r.code, r.error, r.label_error) for r in coded.collect() if r.code}
    assert coded_rows == expected
    assert {(r[0], r[2], r[3]) for r in found if r[1] in (3, 4)} == {(9, None, None), (10, None, None), (11, None, None)}
    assert {r[0] for r in found} == {2, 4, None, 9, 10, 11} and len(found) == 8
    assert {r[4] for r in found if r[1] == 3} == {None}
    with pytest.raises(ValueError):
        compress_vectors(table.where("vec_id = 9"))
    for nothing in (table.where("vec_id = 5"), table.where("vec_id = 10"), table.limit(0)):
        coded, books = compress_vectors(nothing)
        assert books is None and [r.code for r in coded.collect()] in ([], [None])


def test_many_labels_join_without_broadcast(spark, monkeypatch):
    rows = [(i, i // 2, [float(i % 7), 1.0, 2.0, float(i)]) for i in range(50)]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    few = as_dicts(compress_vectors(table, entries=4)[0].orderBy("vec_id"))
    monkeypatch.setattr("tradeloom.llm.vector_codes.BROADCAST_LABELS", 3)
    assert as_dicts(compress_vectors(table, entries=4)[0].orderBy("vec_id")) == few
