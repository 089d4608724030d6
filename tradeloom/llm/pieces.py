"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text gets the whitespace marker in front, every space becomes a marker, and among all ways to cut
the result into pieces the one with the highest sum of piece scores is taken. Pieces are found with a
double-array trie over their bytes. A character that no piece covers costs more than any piece would
and is written as byte pieces. Of equal sums, the one whose last piece is longest wins.

Where no piece reaches over the start of a marker run, or holds a line break, the search splits there
without changing its result. These chunks repeat often; each Python worker keeps the latest ones.

The vocabulary is a public model file that the driver reads; its tables, whose size is that of the
vocabulary, are broadcast. Its scores are taken as they are, also where the file's own algorithm is
merging pairs: then they are negative ranks and the search prefers few, frequent pieces.

Defined cases: a null or empty text has no pieces and decodes to an empty text; texts are encoded
whole; a text that holds the marker character itself decodes to a space there; unknown, control and
out-of-range ids decode to nothing, byte pieces that are not UTF-8 to replacement characters; an empty
table gives an empty result. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import packed, unpacked

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CACHED_CHUNKS = 1 << 17  # of each of two generations
CACHED_LENGTH = 64
PART_ROWS = 128  # rows that a task works on at once: decoding holds some thirty bytes per byte of text
# Fixed values of the public format: the whitespace marker, and what an unknown character costs.
MARK = "▁"
UNKNOWN_COST = 10.0
ROOT = 1
_NONE = -1e300


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and scores by id, the double array, and the ids of the 256 byte pieces."""

    digest: int
    pieces: list[str | None]  # None: nothing to show
    scores: np.ndarray
    byte_ids: list[int]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    unknown: int
    splits: bool  # no piece reaches over the start of a marker run
    breaks: bool  # no piece holds a line break


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as file:
        data = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = range(model.get_piece_size())
    hidden = {i for i in ids if model.is_control(i) or model.is_unknown(i)}
    byte_of = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
    normal = {model.id_to_piece(i): i for i in ids if i not in hidden and not model.is_byte(i) and not model.is_unused(i)}
    if len(byte_of) != 256:
        raise ValueError(f"{path} has no byte pieces")
    base, check, value = double_array({piece.encode(): i for piece, i in normal.items()})
    scores = np.array([model.get_score(i) for i in ids], np.float64)
    return Vocabulary(
        digest=hash(data),
        pieces=[None if i in hidden or model.is_byte(i) else model.id_to_piece(i) for i in ids],
        scores=scores,
        byte_ids=[byte_of[b] for b in range(256)],
        base=base,
        check=check,
        value=value,
        unknown=model.unk_id(),
        splits=not any(MARK in piece.lstrip(MARK) for piece in normal),
        breaks=not any("\n" in piece for piece in normal),
    )


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a trie: state s has the child base[s] + byte if its check is s."""
    children: dict[bytes, list[int]] = {}
    for key in sorted(keys):
        for length in range(len(key)):
            below = children.setdefault(key[:length], [])
            if not below or below[-1] != key[length]:
                below.append(key[length])
    size = 1024
    base, check, value = [0] * size, [0] * size, [-1] * size
    check[: ROOT + 1] = [ROOT] * (ROOT + 1)  # never a child
    # The first free place that leaves any base at zero or more, and where larger families start looking.
    free = hint = ROOT + 257
    states = {b"": ROOT}
    for prefix in sorted(children, key=lambda p: (len(p), p)):
        state, below = states[prefix], children[prefix]
        while len(check) <= free + 512 or len(check) <= hint + 2048:
            base, check, value = base + [0] * size, check + [0] * size, value + [-1] * size
            size *= 2
        while check[free]:
            free += 1
        at = free if len(below) == 1 else max(free, hint)
        looked = 0
        while any(check[at - below[0] + byte] for byte in below):
            at, looked = at + 1, looked + 1
            if len(check) <= at + 512:
                base, check, value = base + [0] * size, check + [0] * size, value + [-1] * size
                size *= 2
        if looked > 64:
            hint = at
        base[state] = at - below[0]
        for byte in below:
            key, child = prefix + bytes([byte]), at - below[0] + byte
            check[child] = state
            if key in children:
                states[key] = child
            if key in keys:
                value[child] = keys[key]
    used = max(i for i, state in enumerate(check) if state) + 257  # a step never leaves the arrays
    pad = max(0, used - len(check))
    arrays = (base + [0] * pad, check + [0] * pad, value + [-1] * pad)
    return tuple(np.array(x[:used], np.int32) for x in arrays)


class Segmenter:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces, self.byte_ids, self.unknown = vocabulary.pieces, vocabulary.byte_ids, vocabulary.unknown
        self.base, self.check, self.value = (x.tolist() for x in (vocabulary.base, vocabulary.check, vocabulary.value))
        self.scores = vocabulary.scores.tolist()
        self.gain = [self.scores[piece] if piece >= 0 else _NONE for piece in self.value]
        self.unknown_score = min(s for s, p in zip(self.scores, self.pieces) if p is not None) - UNKNOWN_COST
        self.bytes_by_id = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        self.shown = [(piece or "").replace(MARK, " ").encode() for piece in self.pieces]
        for piece_id, byte in self.bytes_by_id.items():
            self.shown[piece_id] = bytes([byte])
        parts = ["\n"] * vocabulary.breaks
        plain = "[^" + MARK * vocabulary.splits + "\n" * vocabulary.breaks + "]"
        if vocabulary.splits:
            parts.append(f"{MARK}+{plain}*")
        self.chunks = re.compile("|".join([*parts, f"{plain}+"]) if vocabulary.splits or vocabulary.breaks else "(?s:.+)")
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        places = np.cumsum([0, *map(len, self.shown)])
        # One entry more, which shows nothing, for ids that the vocabulary lacks.
        self.shown_at, self.shown_size = places, np.append(np.diff(places), 0)
        self.shown_bytes = np.frombuffer(b"".join(self.shown), np.uint8)

    def _kept(self, chunk: str) -> bytes:
        """The best pieces of a chunk as 32-bit numbers; those of short chunks are kept for the next time."""
        found = self.recent.get(chunk)
        if found is None:
            found = self.older.get(chunk)
            if found is None:
                found = array("i", self.segment(chunk)).tobytes()
            if len(chunk) <= CACHED_LENGTH:
                if len(self.recent) >= CACHED_CHUNKS:
                    self.older, self.recent = self.recent, {}
                self.recent[chunk] = found
        return found

    def segment(self, chunk: str) -> tuple[int, ...]:
        """The best pieces of a chunk, by Viterbi from left to right."""
        data = chunk.encode()
        size = len(data)
        base, check, gain, unknown = self.base, self.check, self.gain, self.unknown_score
        best, came, last = [_NONE] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        for at in range(size):
            so_far = best[at]
            if so_far == _NONE:
                continue  # inside a character
            state, end = ROOT, at
            while end < size:
                child = base[state] + data[end]
                if check[child] != state:
                    break
                state, end = child, end + 1
                score = gain[state]
                if score > _NONE and so_far + score > best[end]:
                    best[end], came[end], last[end] = so_far + score, at, state
            # An unknown character costs more than any piece, so it only counts where there is no piece.
            first = data[at]
            end = at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)
            if so_far + unknown > best[end]:
                best[end], came[end], last[end] = so_far + unknown, at, -1
        found: list[int] = []
        at = size
        while at:
            start, state = came[at], last[at]
            if state < 0:
                found.extend(self.byte_ids[b] for b in reversed(data[start:at]))
            else:
                found.append(self.value[state])
            at = start
        return tuple(reversed(found))

    def encode(self, text: str | None) -> array:
        return array("i", self.encode_all([text])[0].tobytes())

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text ends."""
        found: list[bytes] = []
        ends = [0]
        for text in texts:
            if text:
                chunks = self.chunks.findall(MARK + text.replace(" ", MARK))
                known = list(map(self.recent.get, chunks))
                # Generations may change meanwhile; what was found stays valid.
                found += [ids if ids is not None else self._kept(chunk) for ids, chunk in zip(known, chunks, strict=True)]
            ends.append(len(found))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.int32), np.concatenate([[0], np.cumsum(sizes)])[ends]

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids that lie one after another; a text ends at each of `ends`, which start with 0."""
        known = np.where((ids >= 0) & (ids < len(self.shown)), ids, len(self.shown))
        sizes = self.shown_size[known]
        byte_ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(byte_ends[-1]) + np.repeat(self.shown_at[known] - byte_ends[:-1], sizes)
        data = self.shown_bytes[places].tobytes()
        cuts = byte_ends[ends].tolist()
        texts = [data[start:end].decode(errors="replace") for start, end in zip(cuts[:-1], cuts[1:], strict=True)]
        return [text[1:] if text.startswith(" ") else text for text in texts]


_latest: dict[int, Segmenter] = {}


def _segmenter(shared) -> Segmenter:
    """The worker's own segmenter, kept from task to task."""
    vocabulary = shared.value
    if vocabulary.digest not in _latest:
        _latest.clear()
        _latest[vocabulary.digest] = Segmenter(vocabulary)
    return _latest[vocabulary.digest]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that what a task holds at once stays small beside long texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(start, PART_ROWS)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), column], names=[batch.schema.names[0], name])


def _encode(shared, source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(shared)
        for part in _parts(batches):
            ids, ends = segmenter.encode_all(pc.struct_field(part.column(0), source).to_pylist())
            yield _with_column(part, "_ids", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))

    return run


def _decode(shared, source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(shared)
        for part in _parts(batches):
            lists = pc.struct_field(part.column(0), source)
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = segmenter.decode_all(flat, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))
            yield _with_column(part, "_text", pa.array(texts, pa.string()))

    return run


def _round_trip(shared, source: str):
    """Texts are encoded, and what was encoded is decoded, while a worker has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(shared)
        for part in _parts(batches):
            ids, ends = segmenter.encode_all(pc.struct_field(part.column(0), source).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            texts = pa.array(segmenter.decode_all(ids, ends), pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), lists, texts], names=[part.schema.names[0], "_ids", "_text"])

    return run


def _mapped(docs: DataFrame, source: str, make, model: str, results: dict[str, tuple[str, T.DataType]]) -> DataFrame:
    """`results` gives the column that `make` adds, and its type, for each result."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    wide = packed(docs)
    schema = T.StructType(wide.schema.fields[:1])
    for field, kind in results.values():
        schema = schema.add(field, kind)
    found = {result: F.col(field) for result, (field, _) in results.items()}
    return unpacked(wide.mapInArrow(make(shared, source), schema), docs.columns, found)


_IDS, _TEXT = ("_ids", T.ArrayType(T.IntegerType())), ("_text", T.StringType())


def encode_pieces(docs: DataFrame, *, model: str = MODEL, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """The documents with `ids_col`, the piece ids of their text."""
    return _mapped(docs, text_col, _encode, model, {ids_col: _IDS})


def decode_pieces(docs: DataFrame, *, model: str = MODEL, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """The documents with `out_col`, the text that their piece ids stand for."""
    return _mapped(docs, ids_col, _decode, model, {out_col: _TEXT})


def round_trip_pieces(
    docs: DataFrame, *, model: str = MODEL, text_col: str = "text", ids_col: str = "piece_ids", out_col: str = "decoded"
) -> DataFrame:
    """What `decode_pieces(encode_pieces(docs))` gives, by one Python worker a task instead of two."""
    return _mapped(docs, text_col, _round_trip, model, {ids_col: _IDS, out_col: _TEXT})
