"""Token ids of all documents in bit-packed files, in ascending order of the document id.

Three passes, each of which Spark can repeat when an executor is lost:

1. Every text is encoded once and its ids, as small integers, are dealt to the file that will hold the
   document. Files are ranges of document ids, cut at quantiles. An id that fills several ranges is spread
   over them by the place of its rows in the input, so a hot id is not one task's work. A task sorts the
   documents of its file, packs them into segments (see `bit_packing`) and hands these to Spark's line
   writer, which writes the bytes as they are to any store.
2. The segments' heads give the ids of each file. Their running sum, one small number per file, is the
   manifest beside the files: the ids of all documents before a file.
3. `read_tokens` reads files as bytes and unpacks them segment by segment.

A writing task holds one segment of about SEGMENT_IDS ids, or one document that is larger; a reader one
file, which holds about what one split of the input does.

Defined cases: a null or empty text has only the end id; documents with a null id come first; documents
that share an id follow one another in the order of the input files; texts are encoded whole; text that
spells a special token gets that token's id, as the tokenizer does by itself; an empty table gives files
without segments, and reading them gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.bit_packing import bits_for, segment_bytes, segments
from tradeloom.llm.common import small_batches
from tradeloom.llm.word_coder import coder_for

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SEGMENT_IDS = 1 << 20
SEGMENT_DOCS = 1 << 16
_NO_ID = -(1 << 63)  # where a null id is sorted


def _kind(bits: int) -> np.dtype:
    return np.dtype("<u2" if bits <= 16 else "<u4")


def _encoded(path: str, end_id: int, borders: list[int], parts: int):
    """(doc_id, place) and text to (doc_id, place, file, n_tokens, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(path)
        kind = _kind(bits_for(max(coder.size, end_id + 1)))
        low = np.array(borders, np.int64)
        for batch in batches:
            ids, counts = coder.encode(batch.column("text"))
            ends = np.cumsum(counts + 1)
            whole = np.empty(int(ends[-1]) if len(ends) else 0, kind)
            inside = np.ones(len(whole), bool)
            inside[ends - 1] = False
            whole[inside], whole[~inside] = ids, end_id
            names = batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            first, last = np.searchsorted(low, names, "left"), np.searchsorted(low, names, "right")
            # An id that is a border, or several at once, fills the files beside them; earlier input parts come first.
            part = np.minimum(batch.column("place").to_numpy(zero_copy_only=False) >> 33, parts - 1)
            file = first + (last - first + 1) * part // parts
            offsets = np.concatenate([[0], ends * kind.itemsize])
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole.tobytes())]
            ).cast(pa.binary())
            columns = [batch.column("doc_id"), batch.column("place"), pa.array(file, pa.int32()), pa.array(counts + 1, pa.int64()), packed]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "file", "n_tokens", "ids"])

    return run


def _packed(bits: int):
    """Sorted documents of a file to its segments, one row each."""
    kind = _kind(bits)

    def segment(docs: list, lengths: list, parts: list, file: int, start: int) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(parts), kind)
        row = segment_bytes(docs, np.array(lengths, np.int64), ids, file, start, bits)
        return pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], names=["segment"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, docs, lengths, parts, start, held = None, [], [], [], 0, 0
        for batch in batches:
            columns = [batch.column(name) for name in ("doc_id", "file", "n_tokens", "ids")]
            for doc_id, file, length, ids in zip(*columns, strict=True):
                file, length = file.as_py(), length.as_py()
                if docs and (file != current or held + length > SEGMENT_IDS or len(docs) == SEGMENT_DOCS):
                    yield segment(docs, lengths, parts, current, start)
                    docs, lengths, parts, start, held = [], [], [], start + held, 0
                if file != current:
                    current, start = file, 0
                docs.append(doc_id.as_py())
                lengths.append(length)
                parts.append(ids.as_buffer())
                held += length
        if docs:
            yield segment(docs, lengths, parts, current, start)

    return run


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(part.file, part.n_ids) for content in batch.column("content") for part in segments(content.as_buffer())]
        numbers = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(numbers[:, 0], pa.int64()), pa.array(numbers[:, 1], pa.int64())], names=["file", "n_ids"])


def _unpacked(starts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for part in segments(content.as_buffer()):
                    ends = np.concatenate([[0], part.ends])
                    ids = pa.py_buffer(part.ids(0, part.n_ids).astype("<u4", copy=False))
                    parts = pa.Array.from_buffers(pa.large_binary(), len(part.ends), [None, pa.py_buffer(ends * 4), ids])
                    columns = [
                        pa.array(part.doc_ids, pa.int64(), mask=~part.named),
                        pa.array(starts[part.file] + part.start + ends[:-1], pa.int64()),
                        pa.array(np.diff(ends), pa.int64()),
                        parts.cast(pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    files: int | None = None,
) -> None:
    """Write the documents' ids and the manifest below `folder`."""
    spark = docs.sparkSession
    small_batches(spark)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    bits = bits_for(max(coder_for(path).size, end_id + 1))
    narrow = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    parts = max(1, narrow.rdd.getNumPartitions())
    files = files or parts
    borders: list[int] = []
    if files > 1:
        cuts = [k / files for k in range(1, files)]
        sorted_id = F.coalesce("doc_id", F.lit(_NO_ID))
        borders = narrow.agg(F.percentile_approx(sorted_id, cuts, max(10_000, 20 * files))).first()[0] or []
    placed = narrow.select("doc_id", F.monotonically_increasing_id().alias("place"), "text")
    schema = "doc_id bigint, place bigint, file int, n_tokens bigint, ids binary"
    coded = placed.mapInArrow(_encoded(path, end_id, borders, parts), schema)
    dealt = coded.repartitionById(files, F.col("file")).sortWithinPartitions("file", "doc_id", "place")
    packed = dealt.mapInArrow(_packed(bits), "segment binary")
    packed.select(F.col("segment").cast("string").alias("value")).write.text(f"{folder}/tokens")

    heads = _contents(spark, folder).mapInArrow(_heads, "file bigint, n_ids bigint")
    starts, total = [], 0
    for file, tokens in sorted(map(tuple, heads.groupBy("file").agg(F.sum("n_ids")).collect())):  # one row per file
        starts.append((file, total))
        total += tokens
    manifest = pa.table({"file": pa.array([x[0] for x in starts], pa.int64()), "start": pa.array([x[1] for x in starts], pa.int64())})
    spark.createDataFrame(manifest).write.parquet(f"{folder}/manifest")


def _contents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{folder}/tokens").select("content")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (little-endian unsigned 32-bit)."""
    starts = dict(map(tuple, spark.read.parquet(f"{folder}/manifest").collect()))  # one row per file
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    return _contents(spark, folder).mapInArrow(_unpacked(starts), schema)
