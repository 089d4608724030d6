"""What a search task of embedding groups holds at once, where most vectors link with each other."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tradeloom.llm.embedding_dedup import PIECE_BYTES, _build, _search


def _table(x):
    n = len(x)
    return pa.table({
        "size": pa.array([x.shape[1]] * n, pa.int32()), "shard": pa.array([0] * n, pa.int32()), "seed": pa.array(np.arange(n) * 7 % n),
        "node": pa.array(np.arange(n) + 10), "copies": pa.array(np.ones(n, np.int64)), "embedding": pa.array(list(x), pa.list_(pa.float32())),
    })


def test_many_links_take_little_memory():
    dice = np.random.default_rng(2)
    x = (dice.normal(size=(1, 32)) + dice.normal(scale=0.1, size=(1500, 32))).astype(np.float32)
    x = np.concatenate([x, dice.normal(size=(500, 32)).astype(np.float32)])[dice.permutation(2000)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True).astype(np.float64)
    counts = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    table = _table(x)
    graph = _build(table)
    tracemalloc.start()
    found = _search(0.9)(graph, table.select(["node", "embedding"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    links = {row["node"] - 10: row["links"] for row in found.to_pylist() if row["links"]}
    assert [links.get(i, 0) for i in range(len(x))] == counts.tolist() and counts.max() > 1400
    assert peak < 150_000_000  # all pairs of a chunk, with both vectors, are 790 MB


def test_a_graph_is_stored_in_pieces():
    x = np.random.default_rng(3).normal(size=(6000, 64)).astype(np.float32)
    graph = _build(_table(x))
    sizes = [len(piece) for piece in graph.column("graph").to_pylist()]
    assert len(sizes) > 1 and max(sizes) <= PIECE_BYTES
    assert sum(sizes) < 6000 * 450  # single precision once: 256 bytes, 24 neighbours: 96, layers and numbers
    backwards = graph.take(pa.array(range(len(sizes))[::-1]))
    queries = pa.table({"node": pa.array(np.arange(100) + 10_000), "embedding": pa.array(list(x[:100]), pa.list_(pa.float32()))})
    links = {row["node"]: row["links"] for row in _search(0.9)(backwards, queries).to_pylist() if row["links"]}
    assert links == {10_000 + i: 1 for i in range(100)}
