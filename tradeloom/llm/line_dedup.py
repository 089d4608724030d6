"""Line dedup with levelled sorted runs of line hashes.

A run holds one row per line hash: how many documents had the line and the largest doc_id among
them. It is a table bucketed and sorted by the hash, so merging two runs needs no shuffle; Spark sorts a
bucket again as it reads it, because it does not rely on the order in a bucket's files. Documents come
in batches of falling doc_id, so that a document is in one batch only. A batch is merge-anti-joined with
the hashes that the runs have already settled (found in `min_docs` documents; the keeper is known,
because ids fall) and the rest becomes a run on level 0. A level that holds `fanout` runs is compacted
into one run of the next level when another run comes to it; the runs that are left after the last batch
are merged as they are read, the third and later ones by a shuffle of hashes.

The texts are read twice and shuffled once. The first reading sums up _HELD_KEYS hashes before anything
is shuffled: of a line that a third of the documents share, each of these sums hands on its `min_docs`
largest ids, which is enough to tell whether that many documents hold the line and which is the last.
Between the readings, a filter holds the settled hashes, 16 bits for each of them from one up to 16
megabytes: the second reading sends on only lines that may be among them, and a join on the whole hash
decides. Beyond the filter's bound more lines pass it, and the result is the same.

Defined cases: a null or empty text is one empty line; rows that repeat a doc_id are one document when
documents are counted, and all rows with the largest doc_id keep their lines; rows without a doc_id are
together one document, smaller than any other; an empty table gives an empty result; result columns
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import LOWER_BYTES, ROW, SPACES, SharedFolder, checkpointed, packed, small_batches, unpacked

MIN_DOCS, MIN_CHARS = 3, 20
BATCHES, FANOUT = 4, 2
FILTER_BITS = 1 << 23, 1 << 27  # least and most
BITS_PER_KEY = 16
_PROBES = 4
_HELD_KEYS = 1 << 16  # hashes that a task sums up before it hands them on


def line_key(line: str, min_chars: int) -> bytes | None:
    """16-byte hash of a line that is stripped and lower-cased in ASCII; None if it is too short."""
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    return blake2b(key.encode("utf-8", "surrogatepass").translate(LOWER_BYTES), digest_size=16).digest()


def _keys(text: str | None, min_chars: int) -> list[bytes | None]:
    return [line_key(line, min_chars) for line in (text or "").split("\n")]


def filter_size(keys: int) -> int:
    """Bits of the filter for a number of hashes, a power of two."""
    least, most = FILTER_BITS
    return min(most, max(least, 1 << (keys * BITS_PER_KEY - 1).bit_length()))


def _probes(keys: np.ndarray, size: int) -> np.ndarray:
    """Bit positions of 16-byte hashes, one row per hash."""
    halves = keys.view("<u4").reshape(-1, _PROBES)
    return (halves % size).astype(np.int64)


def _as_array(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16)


class SortedRuns:
    """Levels of runs, each a bucketed and sorted table (key, docs, last_doc) in the shared folder."""

    def __init__(self, folder: SharedFolder, buckets: int, fanout: int, min_docs: int):
        self.folder, self.buckets, self.fanout, self.min_docs = folder, buckets, fanout, min_docs
        self.spark = folder.spark
        self.levels: list[list[str]] = []
        self._made = 0
        self._stored: set[str] = set()

    def _write(self, rows: DataFrame) -> str:
        self._made += 1
        name = f"run_{self.folder.path.rpartition('-')[2]}_{self._made}"
        self._stored.add(name)
        writer = rows.select("key", "docs", "last_doc").write.bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", f"{self.folder.path}/{name}").saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"drop table if exists {name}")
        self.folder.delete(name)
        self._stored.discard(name)

    def close(self) -> None:
        """Drop what is stored, also after a failure."""
        for name in sorted(self._stored):
            self.drop(name)

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """The batch without the hashes that some run has settled."""
        for name in (name for level in self.levels for name in level):
            settled = self.spark.table(name).where(F.col("docs") >= self.min_docs).select("key")
            batch = batch.join(settled.hint("merge"), "key", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        self._make_room(0)
        self.levels[0].append(self._write(self.unsettled(batch)))

    def _make_room(self, level: int) -> None:
        """Compact a full level, so that no run is written that nothing more is merged with."""
        if len(self.levels) == level:
            self.levels.append([])
        if len(self.levels[level]) == self.fanout:
            self._make_room(level + 1)
            runs, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append(self._write(self.merged(runs)))
            for run in runs:
                self.drop(run)

    def merged(self, names: list[str]) -> DataFrame:
        """Runs merged in key order; the counts of a hash are added up."""
        total = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(
                F.col("key").alias("key2"), F.col("docs").alias("docs2"), F.col("last_doc").alias("last2")
            )
            total = total.join(other.hint("merge"), F.col("key") == F.col("key2"), "full_outer").select(
                F.coalesce("key", "key2").alias("key"),
                (F.coalesce("docs", F.lit(0)) + F.coalesce("docs2", F.lit(0))).alias("docs"),
                F.greatest("last_doc", "last2").alias("last_doc"),
            )
        return total

    def settled(self) -> DataFrame:
        return self.merged([name for level in self.levels for name in level]).where(F.col("docs") >= self.min_docs)


def _summed(bounds: list[int], min_chars: int, min_docs: int):
    """(slice, key, doc_id), slices by falling doc_id: of each hash the `min_docs` largest ids of documents
    that hold it, among as many texts as have _HELD_KEYS hashes."""

    def handed_on(found: dict[tuple[int, bytes], set]) -> pa.RecordBatch:
        rows = []
        for (part, key), docs in found.items():
            known = docs - {None}
            last = known if len(known) <= min_docs else nlargest(min_docs, known)
            rows.extend((part, key, doc) for doc in (last if len(known) == len(docs) else [*last, None]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part for part, _, _ in rows], pa.int32()),
                pa.array([key for _, key, _ in rows], pa.binary()),
                pa.array([doc for _, _, doc in rows], pa.int64()),
            ],
            names=["slice", "key", "doc_id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, bytes], set] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = len(bounds) if doc is None else sum(doc < bound for bound in bounds)
                for key in set(_keys(text, min_chars)) - {None}:
                    docs = found.setdefault((part, key), set())
                    docs.add(doc)
                    if len(docs) > 64 * min_docs:
                        found[part, key] = set(nlargest(min_docs, docs - {None})) | (docs & {None})
                if len(found) >= _HELD_KEYS:
                    yield handed_on(found)
                    found = {}
        yield handed_on(found)

    return run


def _filter_words(settled: DataFrame, size: int) -> DataFrame:
    """The filter's 64-bit words that are not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            bits = np.unique(_probes(_as_array(keys), size))
            words, first = np.unique(bits >> 6, return_index=True)
            values = np.bitwise_or.reduceat(np.uint64(1) << (bits & 63).astype(np.uint64), first) if len(bits) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.int64()), pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())],
                names=["word", "bits"],
            )

    found = settled.select("key").mapInArrow(run, "word bigint, bits bigint")
    return found.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def _suspects(shared, min_chars: int):
    """(doc_id, key) of lines that the filter lets through, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_bits = shared.value
        for batch in batches:
            docs, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = list(set(_keys(text, min_chars)) - {None})
                docs.extend([doc] * len(own))
                keys.extend(own)
            if not keys:
                continue
            bits = _probes(_as_array(keys), 64 * len(filter_bits))
            hit = ((filter_bits[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)
            chosen = np.flatnonzero(hit).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([docs[i] for i in chosen], pa.int64()), pa.array([keys[i] for i in chosen], pa.binary())],
                names=["doc_id", "key"],
            )

    return run


def _without(min_chars: int):
    """The last two columns are the text and the hashes to drop; the rest is passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, drops = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            kept, lines, dropped = [], [], []
            for text, drop in zip(texts, drops, strict=True):
                own = (text or "").split("\n")
                if drop:
                    drop = set(drop)
                    stay = [line for line in own if line_key(line, min_chars) not in drop]
                else:
                    stay = own
                kept.append("\n".join(stay))
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
            new = [pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            names = batch.schema.names[:-2] + ["_kept", "_lines", "_dropped"]
            yield pa.RecordBatch.from_arrays(batch.columns[:-2] + new, names=names)

    return run


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """The documents with `text_col` cut to the lines that stay, and n_lines, n_dropped."""
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    shares = [1 - k / batches for k in range(1, batches)]
    found = narrow.approxQuantile("doc_id", shares, 0.01) if shares else []
    bounds = sorted({int(x) for x in found}, reverse=True)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    folder = SharedFolder(spark, "lines")
    runs = SortedRuns(folder, buckets, fanout, min_docs)
    slices = f"slices_{folder.path.rpartition('-')[2]}"
    held = narrow.mapInArrow(_summed(bounds, min_chars, min_docs), "slice int, key binary, doc_id bigint")
    summed = held.repartition(buckets, "key").distinct().groupBy("slice", "key")
    summed = summed.agg(F.count("*").alias("docs"), F.max("doc_id").alias("last_doc"))
    writer = summed.write.bucketBy(buckets, "key").sortBy("slice", "key")  # one file per bucket, not per slice too
    try:
        writer.option("path", f"{folder.path}/{slices}").saveAsTable(slices)
        for part in range(len(bounds) + 1):
            runs.add(spark.table(slices).where(F.col("slice") == part).select("key", "docs", "last_doc"))
        runs.drop(slices)
        settled = checkpointed(runs.settled().select("key", "last_doc"))
    finally:
        runs.close()
        runs.drop(slices)
        folder.delete()

    size = filter_size(settled.count())
    words = _filter_words(settled, size).toArrow()  # at most size / 64 rows of two numbers
    filter_bits = np.zeros(size // 64, np.uint64)
    filter_bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(filter_bits)
    suspects = narrow.mapInArrow(_suspects(shared, min_chars), "doc_id bigint, key binary")
    drops = (
        suspects.join(settled, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("drops"))  # no more than the document has lines
        .withColumnRenamed("doc_id", "_drop_id")
    )
    wide = packed(docs, _id=F.col(f"`{id_col}`").cast("bigint"), _text=F.col(f"`{text_col}`"))
    joined = wide.join(drops, F.col("_id").eqNullSafe(F.col("_drop_id")), "left").select(
        F.col(ROW).dropFields(text_col).alias(ROW) if len(docs.columns) > 1 else F.lit(None).cast("int").alias(ROW),
        "_text",
        "drops",
    )
    schema = T.StructType(joined.schema.fields[:1])
    schema = schema.add("_kept", "string").add("_lines", "long").add("_dropped", "long")
    done = joined.mapInArrow(_without(min_chars), schema)
    results = {text_col: F.col("_kept"), "n_lines": F.col("_lines"), "n_dropped": F.col("_dropped")}
    order = [name for name in docs.columns if name not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return unpacked(done, docs.columns, results).select(*[f"`{name}`" for name in order])


