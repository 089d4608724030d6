"""Embedding groups against all pairs in double precision."""

import math

import numpy as np
import pytest

from tests.llm.test_simhash import plain_groups
from tradeloom.llm.embedding_dedup import _audited, _Groups, embedding_groups
from tradeloom.llm.small_world import SmallWorld


def unit_rows(dice, rows, size=24):
    x = dice.normal(size=(rows, size))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clustered(dice, singles, groups, members):
    x = [unit_rows(dice, singles)]
    for center in unit_rows(dice, groups):
        x.append(center + dice.normal(scale=0.04, size=(members, len(center))))
    return np.concatenate(x)[dice.permutation(singles + groups * members)]


def test_equals_all_pairs(spark):
    x = clustered(np.random.default_rng(4), 500, 5, 60).astype(np.float32)
    rows = [(i * 3, [float(v) for v in row]) for i, row in enumerate(x)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = {r.vec_id: r for r in embedding_groups(docs, shards=3, blocks=2).collect()}
    wide = x.astype(np.float64)
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    links = wide @ wide.T >= 0.9
    counts = links.sum(axis=1) - 1
    assert sum(found[i * 3].n_links for i in range(len(x))) >= 0.99 * counts.sum() > 1000
    assert all(found[i * 3].n_links <= counts[i] for i in range(len(x)))
    groups = plain_groups({i * 3: i for i in range(len(x))}, lambda a, b: links[a, b])
    assert {i: r.component_id for i, r in found.items()} == groups
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_recall_of_the_graph_and_its_audit():
    dice = np.random.default_rng(9)
    x = clustered(dice, 2500, 3, 300)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = SmallWorld(x)
    truth = set(zip(*map(np.ndarray.tolist, graph.scan(x[:600], 0.9))))
    beam = _audited(graph, x[:600], 0.9, 32)
    found = set(zip(*map(np.ndarray.tolist, graph.near(x[:600], 0.9, beam))))
    assert found <= truth and len(found) >= 0.99 * len(truth)
    assert set(zip(*map(np.ndarray.tolist, graph.near(x[:600], 0.9, len(x))))) == truth


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_tiny_graphs(rows):
    x = unit_rows(np.random.default_rng(rows), rows)
    q, n = SmallWorld(x).near(x, 0.999, 1)
    assert len(q) == rows


def test_groups_join_chains():
    groups = _Groups(50)
    groups.join(np.arange(1, 50)[::-1].copy(), np.arange(0, 49)[::-1].copy())
    assert (groups.root == 0).all()


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 2), (2, [2.0, 0.0], 3), (3, None, 4), (4, [0.0, 0.0], 5), (5, [nan, 1.0], 6),
        (6, [inf, 1.0], 7), (7, [None, 1.0], 8), (8, [], 9), (9, [1.0, 0.0, 0.0], 10), (None, [1.0, 0.0], 11), (10, [-1.0, 0.0], 12),
        (11, [1e30, 1e30], 13), (12, [1e-30, 1e-30], 14),
    ]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, node int")
    out = embedding_groups(docs)
    assert out.columns == ["vec_id", "embedding", "node", "n_links", "component_id", "kept"]
    found = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in out.collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    expected = [(0, 0, None, False), (1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (11, 1, 11, True), (12, 1, 11, False)]
    assert found == sorted(alone + expected, key=str)
    assert embedding_groups(docs.where("vec_id > 99")).collect() == []


def test_equal_vectors_are_counted(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(50, [1.0, 2.0, 3.1])]
    found = {r.vec_id: r for r in embedding_groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert {r.n_links for r in found.values()} == {40} and {r.component_id for r in found.values()} == {0}


def test_every_vector_of_an_id_is_searched(spark):
    """Id 5 has three vectors, of which the largest links to 9, the middle one to 2 and the smallest to none."""
    rows = [
        (5, [0.0, 0.0, 1.0]), (5, [0.0, 1.0, 0.0]), (5, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (5, None), (5, [0.0, 0.0, 0.0]),
        (9, [1.0, 0.1, 0.0]), (2, [0.1, 1.0, 0.0]), (7, [-1.0, 0.0, 0.0]), (8, [1.0, 0.1, 0.0]), (7, [-1.0, 0.0, 0.01]),
    ]
    out = embedding_groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    found = sorted((r.vec_id, tuple(r.embedding or ()), r.n_links, r.component_id, r.kept) for r in out)
    assert found == sorted(
        [
            (5, (0, 0, 1), 0, 2, False), (5, (0, 1, 0), 1, 2, False), (5, (1, 0, 0), 2, 2, False), (5, (1, 0, 0), 2, 2, False),
            (5, (), 0, 5, True), (5, (0, 0, 0), 0, 5, True), (9, (1, 0.1, 0), 2, 2, False), (8, (1, 0.1, 0), 2, 2, False),
            (2, (0.1, 1, 0), 1, 2, True), (7, (-1, 0, 0), 1, 7, True), (7, (-1, 0, 0.01), 1, 7, True),
        ]
    )


def test_the_audit_counts_queries_and_links():
    """A graph that loses the links of lone pairs only: nearly all links are found, half the queries lose theirs."""
    dice = np.random.default_rng(1)
    x = np.concatenate([unit_rows(dice, 1)[[0] * 400] + dice.normal(scale=0.01, size=(400, 24)), unit_rows(dice, 40)])
    x = np.concatenate([x, x[400:] + dice.normal(scale=0.01, size=(40, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = SmallWorld(x)
    queries = graph.unit
    lone = set(range(len(x))) - set(np.flatnonzero((queries @ queries.T >= 0.9).sum(axis=1) > 2).tolist())
    near = graph.near

    def lossy(some, least, beam):
        rows, nodes = near(some, least, beam)
        own = np.einsum("kd,kd->k", some[rows], graph.unit[nodes]) >= 1 - 1e-12
        stay = own | ~np.isin(nodes, list(lone)) | (beam > 200)
        return rows[stay], nodes[stay]

    graph.near = lossy
    assert len(lone) == 80 and _audited(graph, queries, 0.9, 32) > 200
