"""Whole numbers of a fixed bit width, packed without gaps, and the segments of a token file.

Eight numbers of w bits take exactly w bytes, so packing and unpacking are w byte columns over groups of
eight, with no loop over numbers. A number's first bit is the lowest free bit of its first byte.

A segment holds whole documents and can be read alone (all integers little-endian):

    magic      8 bytes
    counts     4 x uint64: bits per id, ids per block, documents, ids
    place      2 x uint64: number of the file, ids of the file before the segment
    ids        int64 per document
    named      uint8 per document: 0 if the document has no id
    ends       uint64 per document: ids of the segment up to its end
    offsets    uint64 per block and one more: first byte of the block in the payload
    payload    blocks of packed ids, each from a byte border on
    line feed  1 byte

A file is one segment after another. A document, or any range of ids, is read from the blocks that cover
it and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Fixed values of the format.
MAGIC = b"IDPACK01"
BLOCK_IDS = 1024
_HEAD = len(MAGIC) + 6 * 8


def bits_for(size: int) -> int:
    """The fewest bits that hold every id of a vocabulary of `size` ids."""
    return max(1, int(size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if not len(ids):
        return b""
    if int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    groups = -(-len(ids) // 8)
    padded = np.zeros(groups * 8, np.uint64)
    padded[: len(ids)] = ids
    padded = padded.reshape(groups, 8)
    out = np.zeros((groups, bits), np.uint8)
    for place in range(8):
        first, shift = divmod(place * bits, 8)
        moved = padded[:, place] << np.uint64(shift)
        for step in range(-(-(shift + bits) // 8)):
            out[:, first + step] |= (moved >> np.uint64(8 * step)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.uint32)
    groups = -(-count // 8)
    columns = np.frombuffer(data, np.uint8, groups * bits).reshape(groups, bits).astype(np.uint64)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for place in range(8):
        first, shift = divmod(place * bits, 8)
        value = columns[:, first].copy()
        for step in range(1, -(-(shift + bits) // 8)):
            value |= columns[:, first + step] << np.uint64(8 * step)
        out[:, place] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


def segment_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, file: int, start: int, bits: int) -> bytes:
    """One segment without its line feed, which the line writer adds."""
    blocks = -(-len(ids) // BLOCK_IDS)
    payload = pack(ids, bits)  # a full block is whole groups of eight, so block borders are byte borders
    offsets = np.minimum(np.arange(blocks + 1, dtype="<u8") * (BLOCK_IDS // 8 * bits), len(payload))
    head = np.array([bits, BLOCK_IDS, len(doc_ids), len(ids), file, start], "<u8")
    named = np.array([doc_id is not None for doc_id in doc_ids], np.uint8)
    table = np.array([doc_id or 0 for doc_id in doc_ids], "<i8")
    ends = np.cumsum(lengths, dtype="<u8")
    return b"".join([MAGIC, *(x.tobytes() for x in (head, table, named, ends, offsets.astype("<u8"))), payload])


class Segment:
    """A segment in a buffer; ids are unpacked when they are asked for."""

    def __init__(self, data: memoryview, at: int = 0):
        if bytes(data[at : at + len(MAGIC)]) != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        counts = np.frombuffer(data, "<u8", 6, at + len(MAGIC)).tolist()
        self.bits, self.block_ids, docs, self.n_ids, self.file, self.start = counts
        at += _HEAD
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.named = np.frombuffer(data, np.uint8, docs, at + 8 * docs).astype(bool)
        self.ends = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        at += 8 * (blocks + 1)
        self.payload = data[at : at + int(self.offsets[-1])]
        self.end = at + int(self.offsets[-1]) + 1

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids from `begin` to before `end`, counted in the segment; reads the covering blocks only."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        first, last = begin // self.block_ids, (end - 1) // self.block_ids
        covered = self.payload[int(self.offsets[first]) : int(self.offsets[last + 1])]
        count = min((last + 1) * self.block_ids, self.n_ids) - first * self.block_ids
        return unpack(covered, count, self.bits)[begin - first * self.block_ids : end - first * self.block_ids]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.ends[place - 1]) if place else 0, int(self.ends[place]))


def segments(data: bytes) -> Iterator[Segment]:
    view, at = memoryview(data), 0
    while at < len(view):
        segment = Segment(view, at)
        yield segment
        at = segment.end
