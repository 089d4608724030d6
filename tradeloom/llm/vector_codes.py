"""Vector code compression: a codebook per part position, trained exactly over whole numbers.

Components become whole numbers, vectors are cut into equal parts, and every part position learns its
entries by rounds of assigning parts to the nearest entry and moving entries to the floor of the mean.
All distances that decide are integers, so the result does not depend on how rows are dealt.

Nearest entries are found with fixed pivots (LAESA). A part's distances to the pivots of its position are
computed once and stored beside it. Each round knows the distances between pivots and entries, and by the
triangle inequality |d(part, pivot) - d(pivot, entry)| is a lower bound of d(part, entry) for each pivot.
Entries are evaluated in the order of their largest bound, in waves that grow; a part is done when the
next bound exceeds its best distance. Bounds are floating-point and lowered by more than their rounding
error; an entry whose bound equals the best distance is still evaluated, so ties fall to the lower index.

A round is one pass over the stored parts. Tasks return sums and counts per entry, at most one row for
each of the position's entries, which Spark adds up; the driver holds codebooks only, whose size is a
parameter. Errors per label are joined back by a broadcast only while there are few labels.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped; rows
without an id come after all others when the first entries are picked, and rows that share an id are
picked in array order; with fewer rows than `entries` the codebook has as many. The length of the
picked rows' first vector is the table's; a row of another length, and one with a component beyond
+-LARGEST after scaling, keeps its row with a null code and error. A length that is no multiple of
`parts` is an error. A label's error beyond a 64-bit number is null. An empty table gives an empty result.
Result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import ROW, checkpointed, packed

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
PIVOTS = 8
LARGEST = 1 << 24  # squared distances of 2**10 components stay below 2**62
BROADCAST_LABELS = 100_000
FIRST_WAVE = 4
_PART_ROWS = 2048  # rows that a task works on at once
_SLACK = 1e-9  # far more than the rounding error of a distance, relative to its terms


@dataclass(frozen=True)
class Codebooks:
    """Entries per part position, and the positions' fixed pivots."""

    entries: tuple[np.ndarray, ...]  # int64, entries x components
    pivots: tuple[np.ndarray, ...]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for x in part.ravel().tolist()).encode()).hexdigest()


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer matrices."""
    gap = left[:, None, :] - right[None, :, :]
    return np.einsum("abk,abk->ab", gap, gap)


def spread_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Pivots far from each other: each next one is farthest from those before it."""
    if not len(entries):
        return entries
    picked = [0]
    nearest = squared(entries, entries[:1])[:, 0]
    while len(picked) < min(count, len(entries)):
        picked.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries, entries[picked[-1:]])[:, 0])
    return entries[picked]


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(squared(parts, pivots).astype(np.float64))


def lower_bounds(to_pivots: np.ndarray, pivot_entry: np.ndarray) -> np.ndarray:
    """Per part and entry, a distance that the true one does not fall below."""
    bound = np.zeros((len(to_pivots), pivot_entry.shape[1]))
    for pivot in range(pivot_entry.shape[0]):
        part, entry = to_pivots[:, pivot, None], pivot_entry[None, pivot]
        np.maximum(bound, np.abs(part - entry) - _SLACK * (part + entry), out=bound)
    return bound


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivot_entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and exact squared distance of each part's nearest entry, and how many were evaluated."""
    bounds = lower_bounds(to_pivots, pivot_entry)
    order = np.argsort(bounds, axis=1, kind="stable")
    # Squares of whole-number distances: comparing squares keeps the test in the integers' terms.
    reach = np.square(np.take_along_axis(bounds, order, axis=1)) * (1 - _SLACK)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    index = np.full(len(parts), len(entries))
    open_rows, at, wave, evaluated = np.arange(len(parts)), 0, FIRST_WAVE, 0
    while len(open_rows) and at < len(entries):
        tried = order[open_rows, at : at + wave]
        gap = entries[tried] - parts[open_rows, None, :]
        found = np.einsum("rwk,rwk->rw", gap, gap)
        evaluated += found.size
        least = found.min(axis=1)
        who = np.where(found == least[:, None], tried, len(entries)).min(axis=1)
        better = (least < best[open_rows]) | ((least == best[open_rows]) & (who < index[open_rows]))
        best[open_rows[better]], index[open_rows[better]] = least[better], who[better]
        at, wave = at + wave, wave * 2
        if at < len(entries):
            open_rows = open_rows[reach[open_rows, at] <= best[open_rows]]
    return index, best, evaluated


def _tables(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _PART_ROWS):
            part = batch.slice(start, _PART_ROWS)
            yield part, part.column("numbers").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _with_pivots(books: Codebooks, length: int):
    """Adds each part's distances to its position's pivots, position by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers in _tables(batches, length):
            found = [
                pivot_distances(x, pivots) for x, pivots in zip(np.split(numbers, len(books.pivots), axis=1), books.pivots, strict=True)
            ]
            flat = np.concatenate(found, axis=1)
            ends = pa.array(np.arange(part.num_rows + 1) * flat.shape[1], pa.int32())
            distances = pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, distances], names=[*part.schema.names, "distances"])

    return run


def _assigned(part: pa.RecordBatch, numbers: np.ndarray, books: Codebooks, between: list[np.ndarray]):
    """Per position: parts, nearest entries and squared distances."""
    flat = part.column("distances").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
    at = 0
    for x, entries, pivot_entry in zip(np.split(numbers, len(books.entries), axis=1), books.entries, between, strict=True):
        index, best, _ = nearest(x, flat[:, at : at + len(pivot_entry)], entries, pivot_entry)
        at += len(pivot_entry)
        yield x, index, best


def _between(books: Codebooks) -> list[np.ndarray]:
    return [pivot_distances(pivots, entries) for pivots, entries in zip(books.pivots, books.entries, strict=True)]


def _sums(books: Codebooks, length: int):
    """(part, entry, count, sums) of a task's rows, one row per entry that has parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = _between(books)
        sums = [np.zeros(entries.shape, np.int64) for entries in books.entries]
        counts = [np.zeros(len(entries), np.int64) for entries in books.entries]
        for part, numbers in _tables(batches, length):
            for position, (x, index, _) in enumerate(_assigned(part, numbers, books, between)):
                np.add.at(sums[position], index, x)
                counts[position] += np.bincount(index, minlength=len(counts[position]))
        for position, (total, count) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(count)
            ends = pa.array(np.arange(len(used) + 1) * total.shape[1], pa.int32())
            columns = [
                pa.array(np.full(len(used), position), pa.int32()),
                pa.array(used, pa.int32()),
                pa.array(count[used], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(total[used].ravel(), pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "count", "sums"])

    return run


def _codes(books: Codebooks, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = _between(books)
        for part, numbers in _tables(batches, length):
            found = [(index, best) for _, index, best in _assigned(part, numbers, books, between)]
            codes = np.stack([index for index, _ in found], axis=1)
            error = pa.array(np.sum([best for _, best in found], axis=0), pa.int64())
            text = pa.array(["".join(f"{x:02x}" for x in row) for row in codes.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(ROW), text, error], names=[ROW, "code", "error"])

    return run


def _moved(books: Codebooks, found: DataFrame) -> Codebooks:
    """Entries at the floor of their parts' mean; unused entries stay."""
    width = max(x.shape[1] for x in books.entries)
    added = [F.sum(F.col("sums")[place]).alias(f"s{place}") for place in range(width)]
    totals = found.groupBy("part", "entry").agg(F.sum("count").alias("count"), *added)
    entries = [x.copy() for x in books.entries]
    for row in totals.collect():  # at most one row per entry
        entries[row[0]][row[1]] = [x // row[2] for x in row[3:]]
    return Codebooks(tuple(entries), books.pivots)


def usable_vector(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole_numbers(vector: Column, scale: int, largest: int) -> Column:
    """floor(scale * x) of every component; null if one lies beyond +-largest."""
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * scale) <= largest)
    return F.when(fits, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def _first_entries(rows: DataFrame, parts: int, entries: int, pivots: int) -> tuple[Codebooks, int] | None:
    first = rows.where(F.col("numbers").isNotNull()).select("id", "numbers")
    picked = first.orderBy(F.col("id").asc_nulls_last(), "numbers").limit(entries).collect()  # bounded by the parameter
    if not picked:
        return None
    length = len(picked[0][1])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} parts")
    matrix = np.array([row[1] for row in picked if len(row[1]) == length], np.int64)
    books = tuple(np.split(matrix, parts, axis=1))
    return Codebooks(books, tuple(spread_pivots(book, pivots) for book in books)), length


def compress_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Codebooks | None]:
    """The rows with code, error and label_error, and the codebooks (none for a table without vectors)."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part, so at most 256 entries")
    columns = [name for name in vectors.columns if name not in ("code", "error", "label_error")]
    wide = packed(vectors, id=F.col(f"`{id_col}`"), label=F.col(f"`{label_col}`"), vector=F.col(f"`{vector_col}`"))
    kept = wide.where(usable_vector(F.col("vector")))
    rows = checkpointed(kept.select(ROW, "id", "label", whole_numbers(F.col("vector"), scale, LARGEST).alias("numbers")))
    start = _first_entries(rows, parts, entries, pivots)
    if start is None:
        books = coded = None
    else:
        books, length = start
        fits = F.coalesce(F.size("numbers") == length, F.lit(False))
        with_distances = _schema(rows, numbers="array<bigint>", distances="array<double>")
        stored = checkpointed(rows.where(fits).select(ROW, "numbers").mapInArrow(_with_pivots(books, length), with_distances))
        for _ in range(rounds):
            sums = stored.select("numbers", "distances").mapInArrow(_sums(books, length), "part int, entry int, count bigint, sums array<bigint>")
            books = _moved(books, sums)
        coded = stored.mapInArrow(_codes(books, length), _schema(rows, code="string", error="bigint"))
    nothing = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")]
    if coded is None:
        every = rows.select(ROW, *nothing)
    else:
        every = coded.unionByName(rows.where(~fits).select(ROW, *nothing))
    every = checkpointed(every.withColumn("label", F.col(ROW).getField(label_col)))
    sums = every.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    sums = checkpointed(sums.select(F.col("label").alias("of"), F.expr("try_cast(total as bigint)").alias("label_error")))
    few = sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    joined = every.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select(*[F.col(ROW).getField(name).alias(name) for name in columns], "code", "error", "label_error"), books


def _schema(rows: DataFrame, **more: str) -> T.StructType:
    return T.StructType([rows.schema[ROW], *[T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in more.items()]])
