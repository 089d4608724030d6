"""Embedding near-dedup with small-world graphs per shard.

Vectors are dealt out by hash into shards; a task builds the hierarchical navigable small-world graph
of a shard. Every vector is then looked up in every shard, a block of queries against one graph per
task. Beams widen twofold: for a query whose beam is full of links, and for a whole block while the
audit finds less than AUDIT_RECALL of the links of a sample of its queries, which it compares with the
full shard; all links together must reach that share, and the mean over the queries that have links, so
that a large cluster does not hide queries with one. A beam as wide as the shard is a complete scan, so
an audit passes in the end. Single precision finds candidates, double precision decides.

Equal vectors are one node from the start, however many rows have them; a vec_id may have several nodes. A task does not return its
pairs: it adds up the links per query and joins linked nodes into groups as it goes, and returns one
row per query and one per group member. Components over these come from repeated joins.

Per task memory is one shard, one block and a piece of the pairs; `shards` and `blocks` follow the number
of vectors. A graph is stored and shuffled in pieces, once for each block, so a block is large, and audited in
parts of AUDIT_ROWS. All blocks meet all shards, which is the method's price: work grows with vectors times
shards.

Defined cases: a null, empty or zero vector, or one with a null or non-finite component, links with
nothing, whatever other rows have its vec_id; vectors of different length do not link; equal rows are one
vector with one result; rows that repeat a vec_id with other vectors are vectors of their own, count as
such in n_links, and reach each other, as they have the same id; rows without a vec_id have no component,
no links and are not kept; an empty table gives an empty result. Result columns replace input columns of
the same name.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import checkpointed, connected_components, packed, unpacked
from tradeloom.llm.small_world import SmallWorld, unit_rows

COSINE = 0.9
LEAST_SHARDS, SHARD_ROWS = 8, 100_000
LEAST_BLOCKS, BLOCK_ROWS = 4, 131_072
AUDIT_ROWS = 16_384
PIECE_BYTES = 1 << 20  # of a graph in a row
TASKS_PER_PARTITION = 8  # at most, of the search to a partition of other shuffles
BEAM = 32
AUDIT_QUERIES, AUDIT_RECALL = 48, 0.99
_CHUNK = 1024  # queries searched at once
_SAMPLE = 16  # queries audited at once


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of vectors as they are; all have the same length."""
    arrays = column.combine_chunks()
    return arrays.flatten().to_numpy(zero_copy_only=False).reshape(len(arrays), -1)


def _build(table: pa.Table) -> pa.Table:
    size, shard = table.column("size")[0].as_py(), table.column("shard")[0].as_py()
    ordered = table.sort_by([("seed", "ascending"), ("node", "ascending")])
    graph = SmallWorld(_matrix(ordered.column("embedding")))
    nodes = ordered.column("node").to_numpy()[graph.order]
    weights = ordered.column("copies").to_numpy()[graph.order]
    held = memoryview(pickle.dumps((nodes, weights, graph), protocol=5))
    pieces = [held[at : at + PIECE_BYTES] for at in range(0, len(held), PIECE_BYTES)]
    same = [pa.array([number] * len(pieces), pa.int32()) for number in (size, shard)]
    numbers = pa.array(range(len(pieces)), pa.int32())
    return pa.Table.from_arrays([*same, numbers, pa.array(pieces, pa.binary())], names=["size", "shard", "piece", "graph"])


def _restored(graphs: pa.Table) -> tuple[np.ndarray, np.ndarray, SmallWorld]:
    order = np.argsort(graphs.column("piece").to_numpy())
    pieces = graphs.column("graph")
    return pickle.loads(b"".join(memoryview(pieces[int(at)].as_buffer()) for at in order))


class _Groups:
    """Groups of linked nodes, joined as pairs come in."""

    def __init__(self, members: int):
        self.root = np.arange(members)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        """Both are node numbers; smaller roots win."""
        root = self.root
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = root[root]
                if (above == root).all():
                    break
                root[:] = above


def _audited(graph: SmallWorld, queries: np.ndarray, least: float, beam: int) -> int:
    """The beam with which a sample of the block finds enough of its links."""
    sample = queries[np.unique(np.linspace(0, len(queries) - 1, AUDIT_QUERIES).round().astype(int))]
    linked = np.zeros(0, np.int64)
    if len(queries) > AUDIT_QUERIES:
        # Links may be rare: add queries for which a first look finds some.
        hits = np.unique(graph.near(queries[: 8 * _CHUNK], least + (1 - least) / 2, BEAM // 2)[0])
        linked = hits[np.unique(np.linspace(0, max(len(hits) - 1, 0), AUDIT_QUERIES).round().astype(int))] if len(hits) else hits
    sample = np.concatenate([sample, queries[linked]])
    parts = [sample[at : at + _SAMPLE] for at in range(0, len(sample), _SAMPLE)]
    while beam < len(graph.small):
        linked, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in parts:
            truth = _linked(graph, part, *graph.scan(part, least))
            both = np.intersect1d(truth, _linked(graph, part, *graph.near(part, least, beam)), assume_unique=True)
            linked = np.append(linked, np.bincount(truth // len(graph.small), minlength=len(part)))
            found = np.append(found, np.bincount(both // len(graph.small), minlength=len(part)))
        some = linked > 0
        if not some.any() or min(found.sum() / linked.sum(), (found[some] / linked[some]).mean()) >= AUDIT_RECALL:
            break
        beam *= 2
    return beam


def _linked(graph: SmallWorld, queries: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Pairs as one number each, without a query's own node."""
    other = graph.cosines(queries, rows, nodes) < 1 - 1e-12
    return np.unique(rows[other] * len(graph.small) + nodes[other])


def _search(least: float):
    """(node, links, group) of a block of queries in one shard: links per query, or the smallest member
    of a member's group."""

    def run(graphs: pa.Table, queries: pa.Table) -> pa.Table:
        found = [pa.array([], pa.int64())] * 3
        if len(graphs) and len(queries):
            nodes, weights, graph = _restored(graphs)
            names, vectors = queries.column("node").to_numpy(), _matrix(queries.column("embedding"))
            everyone, member = np.unique(np.concatenate([nodes, names]), return_inverse=True)
            groups = _Groups(len(everyone))
            links = np.zeros(len(names), np.int64)
            for first in range(0, len(names), AUDIT_ROWS):
                part = unit_rows(vectors[first : first + AUDIT_ROWS])
                beam = _audited(graph, part, least, BEAM)
                for at in range(0, len(part), _CHUNK):
                    for rows, hits in graph.near_pieces(part[at : at + _CHUNK], least, beam):
                        rows = rows + first + at
                        other = names[rows] != nodes[hits]
                        rows, hits = rows[other], hits[other]
                        np.add.at(links, rows, weights[hits])
                        groups.join(member[len(nodes) + rows], member[hits])
            some = np.flatnonzero(links)
            below = np.flatnonzero(groups.root != np.arange(len(everyone)))
            found = [
                pa.array(np.concatenate([names[some], everyone[below]]), pa.int64()),
                pa.array(np.concatenate([links[some], np.zeros(len(below), np.int64)]), pa.int64()),
                pa.array([*[None] * len(some), *everyone[groups.root[below]].tolist()], pa.int64()),
            ]
        return pa.Table.from_arrays(found, names=["node", "links", "group"])

    return run


def embedding_groups(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = COSINE,
    shards: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """The rows with n_links, component_id and kept."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0)
    narrow = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding"))
    named = narrow.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(usable, F.lit(False)))
    named = checkpointed(named.distinct())
    nodes = named.groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    # Numbers of nodes differ from run to run; `seed`, which deals them out and orders a graph, does not.
    nodes = nodes.withColumn("size", F.size("embedding").cast("int")).withColumn("seed", F.xxhash64("embedding"))
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    total = nodes.count()
    shards = shards or max(LEAST_SHARDS, -(-total // SHARD_ROWS))
    blocks = blocks or max(LEAST_BLOCKS, -(-total // BLOCK_ROWS))

    shard = F.pmod(F.xxhash64("seed"), F.lit(shards)).cast("int")
    graphs = nodes.withColumn("shard", shard).groupBy("size", "shard")
    graphs = checkpointed(graphs.applyInArrow(_build, "size int, shard int, piece int, graph binary"))
    block = F.pmod(F.xxhash64("seed", F.lit(1)), F.lit(blocks)).cast("int")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = nodes.select("size", "node", "embedding", block.alias("block"), every_shard.alias("shard"))
    served = graphs.select("size", "shard", "piece", "graph", every_block.alias("block"))
    keys = ["size", "shard", "block"]
    # By number, so that adaptive execution does not merge groups that are small in bytes and long to search.
    tasks = min(2 * shards * blocks, TASKS_PER_PARTITION * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    served, queries = served.repartition(tasks, *keys), queries.repartition(tasks, *keys)
    searched = served.groupBy(*keys).cogroup(queries.groupBy(*keys))
    found = checkpointed(searched.applyInArrow(_search(least), "node bigint, links bigint, group bigint"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where(F.col("group").isNotNull()).select(F.col("node").alias("a"), F.col("group").alias("b"))
    # Nodes of one id reach each other.
    members = named.join(nodes.select("embedding", "node"), "embedding").select("vec_id", "node")
    repeated = named.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    several = checkpointed(members.join(repeated, "vec_id"))
    first = several.groupBy("vec_id").agg(F.min("node").alias("b"))
    edges = edges.union(several.join(first, "vec_id").select(F.col("node").alias("a"), "b"))
    labels = connected_components(edges).withColumnsRenamed({"node": "member", "component": "label"})
    joined = nodes.join(links, "node", "left").join(labels, F.col("node") == F.col("member"), "left")
    joined = checkpointed(joined.select("embedding", "least_id", "copies", "links", "label"))
    least_ids = joined.where("label is not null").groupBy("label").agg(F.min("least_id").alias("component"))
    per_node = joined.join(least_ids, "label", "left").select(
        F.col("embedding").alias("found_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least_id").alias("component_id"),
    )
    per_node = checkpointed(per_node)
    known = F.when(F.col(f"`{id_col}`").isNotNull(), F.col(f"`{vector_col}`"))
    wide = packed(vectors, _id=F.col(f"`{id_col}`").cast("bigint"), _vector=known)
    wide = wide.join(per_node, F.col("_vector") == F.col("found_vector"), "left")
    component = F.coalesce("component_id", "_id")
    results = {
        "n_links": F.coalesce("n_links", F.lit(0)).cast("bigint"),
        "component_id": component,
        "kept": F.coalesce(component == F.col("_id"), F.lit(False)),
    }
    return unpacked(wide, vectors.columns, results)
