"""SimHash near-dedup: segment popcounts as a lower bound in a grid, then exact verification.

A fingerprint is cut into `segments` pieces, and the bit counts of the pieces are a point in a small
integer lattice. Differing in d bits moves the point by at most d in Manhattan distance, so pairs
within 2 bits lie within distance 2. On the lattice, two points within distance 2 always share a cell
at distance 1 from both (or are equal and share their own). Each fingerprint is therefore put into its
own cell and the cells one step away, and only cells that hold two different fingerprints go on.

Verification is exact and emits no pairs. Two fingerprints differ in at most 2 bits just when some
64-bit word is at most one bit from both. In a shared cell, a fingerprint lists the words one bit away
that belong to this cell; a word that two fingerprints list links them. A word has at most 65
neighbours, so no group is larger, however many near copies a text has.

Work is per distinct fingerprint: exact copies, however many, are one row from the start.

Defined cases: a null or empty text has fingerprint zero, linked like any other; texts are read whole;
repeated rows get the same component; a null doc_id is never the smallest unless a component has no
other; an empty table gives an empty result. The result columns replace input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import LOWER_BYTES, SPACES, checkpointed, connected_components, packed, unpacked

SHINGLE, MAX_BITS, SEGMENTS, SEED = 3, 2, 16, 42
_SPACE_TABLE = bytes(0x20 if chr(b) in SPACES else b for b in range(256))
_BLOCK = 65_536  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; each is set if it is in more than half of the shingles' XXH64."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).translate(_SPACE_TABLE)
    words = data.split(b" ")
    words = [word for word in words if word]
    if not words:
        return 0
    line = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_of(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[shingle - 1 :].tolist()
    first = starts[: len(last)].tolist()
    hashes = np.fromiter((hash_of(line[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(last))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def _fingerprints(shingle: int):
    """The last column is the text; its fingerprint, as a signed 64-bit number, takes its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column(batch.num_columns - 1)]
            signed = np.array(found, np.uint64).view(np.int64)
            columns = [*batch.columns[:-1], pa.array(signed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    return run


def _grid(segments: int):
    """(cell, fp, step): the cells of a fingerprint; step is 0 for its own one, s + 1 or -(s + 1) where
    segment s has one bit more or less."""
    width = 64 // segments
    mask = np.uint64((1 << width) - 1)
    # A cell's key is the sum of its coordinates times fixed odd numbers.
    odd = np.array([xxhash.xxh64_intdigest(str(s).encode(), SEED) | 1 for s in range(segments)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            counts = np.stack([np.bitwise_count((fps >> np.uint64(width * s)) & mask) for s in range(segments)], axis=1)
            own = (counts.astype(np.uint64) * odd).sum(axis=1, dtype=np.uint64)
            cells, steps, kept = [own], [np.zeros(len(fps), np.int32)], [fps]
            for s in range(segments):
                for sign, inside in ((1, counts[:, s] < width), (-1, counts[:, s] > 0)):
                    cells.append(own[inside] + odd[s] if sign > 0 else own[inside] - odd[s])
                    steps.append(np.full(int(inside.sum()), sign * (s + 1), np.int32))
                    kept.append(fps[inside])
            columns = [np.concatenate(cells).view(np.int64), np.concatenate(kept).view(np.int64), np.concatenate(steps)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "fp", "step"])

    return run


def _middles(segments: int):
    """(middle, fp): from (fp, step), the words whose popcounts give the cell, at most one bit from fp."""
    width = 64 // segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, steps = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            middles, kept = [fps[steps == 0]], [fps[steps == 0]]
            fps, steps = fps[steps != 0], steps[steps != 0]
            first = np.uint64(width) * (np.abs(steps) - 1).astype(np.uint64)
            for bit in range(width):
                flip = np.uint64(1) << (first + np.uint64(bit))
                fits = ((fps & flip) != 0) == (steps < 0)
                middles.append(fps[fits] ^ flip[fits])
                kept.append(fps[fits])
            columns = [np.concatenate(middles).view(np.int64), np.concatenate(kept).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["middle", "fp"])

    return run


def links_of(fps: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """(a, b): links that join up all distinct `fp` that differ in at most MAX_BITS bits."""
    placed = fps.select("fp").mapInArrow(_grid(segments), "cell bigint, fp bigint, step int")
    bounds = placed.groupBy("cell").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    shared = bounds.where("low < high").select("cell")
    candidates = placed.join(shared, "cell").select("fp", "step")
    middles = candidates.mapInArrow(_middles(segments), "middle bigint, fp bigint")
    # At most 65 fingerprints are within one bit of a word.
    met = middles.groupBy("middle").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return met.select("b", F.explode("all").alias("a")).where("a <> b")


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, **columns) -> DataFrame:
    """Packed documents with `columns` and `fp`."""
    wide = packed(docs, **columns, _text=F.col(f"`{text_col}`"))
    schema = wide.drop("_text").schema.add("fp", "long")
    return wide.mapInArrow(_fingerprints(shingle), schema)


def _resolved(named: DataFrame, segments: int) -> DataFrame:
    """(fp, root, first_doc, first_fp) of each distinct fingerprint, from (doc_id, fp); the first
    document of a group is the one with the smallest doc_id, nulls last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("fp").alias("first_fp")))
    heads = checkpointed(named.groupBy("fp").agg(first.alias("first")))
    labels = connected_components(links_of(heads, segments))
    rooted = heads.join(labels, heads["fp"] == labels["node"], "left")
    rooted = checkpointed(rooted.select("fp", F.coalesce("component", "fp").alias("root"), "first"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("group_first"))
    chosen = F.col("group_first")
    return checkpointed(
        rooted.select("fp", "root").join(groups, "root").select(
            "fp", "root", chosen["doc_id"].alias("first_doc"), chosen["first_fp"].alias("first_fp")
        )
    )


def simhash_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, segments: int = SEGMENTS
) -> DataFrame:
    """(id_col, fingerprint, component_id) of each row: hex digits, and the smallest id of its group."""
    named = with_fingerprints(docs.select(id_col, text_col), text_col, shingle, doc_id=F.col(f"`{id_col}`"))
    named = checkpointed(named.select("doc_id", "fp"))
    groups = _resolved(named, segments).select("fp", "first_doc")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return named.join(groups, "fp").select(
        F.col("doc_id").alias(id_col), hexed.alias("fingerprint"), F.col("first_doc").alias("component_id")
    )


def drop_near_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, segments: int = SEGMENTS
) -> DataFrame:
    """One document of each group: the one with the smallest id, and of repeated rows the smallest text."""
    wide = with_fingerprints(docs, text_col, shingle, doc_id=F.col(f"`{id_col}`"))
    groups = _resolved(checkpointed(wide.select("doc_id", "fp")), segments)
    kept = wide.join(groups, "fp").where((F.col("fp") == F.col("first_fp")) & F.col("doc_id").eqNullSafe(F.col("first_doc")))
    one = kept.groupBy("root").agg(F.min_by("_row", F.coalesce(F.col("_row")[text_col], F.lit(""))).alias("_row"))
    return unpacked(one, docs.columns, {})
