"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words; a run of more than LONG_WORD bytes without white
space is several words. Every passage of the whole text is encoded: shares of hashed byte trigrams and of character kinds, word lengths, distinct and repeated words. A
small network learns from document labels alone which passages matter: a gated attention weight per
passage (tanh times sigmoid), softmax over the bag, and a logistic score of the weighted passage
representation.

Labels come from at most SAMPLE_ROWS documents of either class (smallest hash of the id), none of them
held out, and from as many of these as have SAMPLE_PASSAGES passages together; whole bags are trained
on. Both bounds keep what the driver trains on small. The network has a fixed size and is broadcast.
Long texts are encoded in pieces that end where a passage ends, so that the passages are those of the
whole text and the work on one piece is bounded.

Defined cases: a null, empty or blank text is one empty passage; labels with null are not used, a
document with several labels has the largest; repeated rows are scored each, and trained on as one (the
bag that comes first in byte order); a null id is never a training document; without labelled documents of both classes every score is 0.5; an empty table gives
an empty result. The result column `quality_score` replaces an input column of that name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import SPACES, checkpointed, packed, unpacked
from tradeloom.llm.toxicity import known_labels, labelled_sample, sample_documents

SAMPLE_ROWS = 4_000  # labelled documents of either class
SAMPLE_PASSAGES = 250_000  # of all of them, 75 megabytes
PASSAGE_WORDS = 64
LONG_WORD = 1 << 14  # bytes
GRAM_BUCKETS = 64
EPOCHS, BATCH, RATE, SEED = 14, 128, 3e-3, 11
HIDDEN, GATE = 24, 12
GOOD_FROM = 0.5
_PIECE_BYTES = 200_000  # longer texts are encoded in pieces of whole passages
_BLOCK_BYTES = 1_000_000
_SPACE = np.array([chr(b) in SPACES for b in range(256)])
_SYMBOL = np.array([chr(b) in "#*$%&|<>!@^~_=+{}[]\\/" for b in range(256)])
_KINDS = [
    np.array([chr(b).isascii() and chr(b).islower() for b in range(256)]),
    np.array([chr(b).isascii() and chr(b).isupper() for b in range(256)]),
    np.array([chr(b).isascii() and chr(b).isdigit() for b in range(256)]),
    np.array([b >= 128 for b in range(256)]),
    _SYMBOL,
]
FEATURES = GRAM_BUCKETS + len(_KINDS) + 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)


def _word_starts(flat: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Where the words of some bytes start."""
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    lengths = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1 - starts
    long = np.flatnonzero(lengths > LONG_WORD)
    if not len(long):
        return starts
    within = [np.arange(starts[i] + LONG_WORD, starts[i] + lengths[i], LONG_WORD) for i in long]
    return np.sort(np.concatenate([starts, *within]))


def _pieces(text: bytes) -> list[tuple[bytes, bool]]:
    """A long text in pieces of whole passages. All but the last go on for two bytes, which the trigrams
    of the last word reach into; these make a passage of their own, and the mark says that there is one."""
    if len(text) <= _PIECE_BYTES:
        return [(text, False)]
    flat = np.frombuffer(text, np.uint8)
    first = _word_starts(flat, _SPACE[flat])[::PASSAGE_WORDS]
    found, start = [], 0
    while len(text) - start > _PIECE_BYTES:
        later = first[np.searchsorted(first, start, side="right") :]
        if not len(later):
            break
        cut = int(later[max(0, np.searchsorted(later, start + _PIECE_BYTES, side="right") - 1)])
        found.append((text[start : cut + 2], True))
        start = cut
    return [*found, (text[start:], False)]


def encode_block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the number of the text of each passage."""
    flat = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(text) + 1 for text in texts])
    space = _SPACE[flat]
    starts = _word_starts(flat, space)
    if not len(starts):
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    text_of = np.searchsorted(ends, starts, side="right")
    first = np.searchsorted(text_of, np.arange(len(texts)))  # first word of each text
    inside = (np.arange(len(starts)) - first[text_of]) // PASSAGE_WORDS
    new = np.concatenate([[True], (text_of[1:] != text_of[:-1]) | (inside[1:] != inside[:-1])])
    passage_of_word = np.cumsum(new) - 1
    passages = int(passage_of_word[-1]) + 1
    places = np.flatnonzero(~space)
    word = np.searchsorted(starts, places, side="right") - 1
    passage, letters = passage_of_word[word], flat[places]

    chars = np.bincount(passage, minlength=passages).astype(np.float64)
    words = np.bincount(passage_of_word, minlength=passages).astype(np.float64)
    columns = [np.bincount(passage[kind[letters]], minlength=passages) / chars for kind in _KINDS]
    lengths = np.bincount(word, minlength=len(starts))
    hashes = np.zeros(len(starts), np.uint64)
    scaled = (letters.astype(np.uint64) + np.uint64(1)) * _POWERS[(places - starts[word]) % 64]
    hashes = np.add.reduceat(scaled * _ODD, np.searchsorted(word, np.arange(len(starts))))
    same = (hashes[1:] == hashes[:-1]) & (passage_of_word[1:] == passage_of_word[:-1])
    pairs = np.lexsort((hashes, passage_of_word))
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (hashes[pairs][1:] != hashes[pairs][:-1]) | (passage_of_word[pairs][1:] != passage_of_word[pairs][:-1])
    columns += [
        np.bincount(passage_of_word[pairs[fresh]], minlength=passages) / words,
        np.bincount(passage_of_word[1:][same], minlength=passages) / words,
        np.log1p(words),
        np.bincount(passage_of_word, weights=lengths, minlength=passages) / words / 10,
        np.bincount(passage_of_word, weights=lengths.astype(float) ** 2, minlength=passages) / words / 100,
    ]
    wide = flat.astype(np.uint64)
    grams = (wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]) * _ODD >> np.uint64(58)
    usable = places + 2 < ends[text_of[word]]  # up to the break behind a text, never into the next one
    cells = passage[usable] * GRAM_BUCKETS + grams[places[usable]].astype(np.int64)
    shares = np.bincount(cells, minlength=passages * GRAM_BUCKETS).reshape(passages, GRAM_BUCKETS)
    shares = shares / np.maximum(shares.sum(axis=1, keepdims=True), 1) * GRAM_BUCKETS
    return np.column_stack([shares, *columns]).astype(np.float32), text_of[new]


def encode_bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features in the order of the texts, and the number of passages of each text."""
    found, owners = [], []
    block, owner_of, marks, held = [], [], [], 0

    def close() -> None:
        nonlocal block, owner_of, marks, held
        if block:
            features, text_of = encode_block(block)
            last = np.concatenate([text_of[1:] != text_of[:-1], np.ones(min(len(text_of), 1), bool)])
            own = ~(last & np.array(marks)[text_of])
            found.append(features[own])
            owners.append(np.array(owner_of)[text_of[own]])
        block, owner_of, marks, held = [], [], [], 0

    for number, text in enumerate(texts):
        for data, goes_on in _pieces((text or "").encode("utf-8", "surrogatepass")):
            block.append(data)
            owner_of.append(number)
            marks.append(goes_on)
            held += len(data)
            if held > _BLOCK_BYTES:
                close()
    close()
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    empty = np.setdiff1d(np.arange(len(texts)), owner)
    features = np.concatenate([*found, np.zeros((len(empty), FEATURES), np.float32)])
    order = np.argsort(np.concatenate([owner, empty]), kind="stable")
    sizes = np.bincount(np.concatenate([owner, empty]).astype(np.int64), minlength=len(texts))
    return features[order], sizes


@dataclass
class AttentionModel:
    """Standardisation and weights; score() is 0.5 everywhere while there are none."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.clip((features - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        left, right = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["sigmoid"])))
        gate = left * right
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        bag = np.repeat(np.arange(len(sizes)), sizes)
        energy = gate @ w["attend"]
        energy = np.exp(energy - np.maximum.reduceat(energy, starts)[bag])
        attention = energy / np.add.reduceat(energy, starts)[bag]
        z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
        logit = np.clip(z @ w["score"] + w["score_bias"], -30, 30)
        return {"x": x, "h": h, "left": left, "right": right, "gate": gate, "starts": starts, "bag": bag,
                "attention": attention, "z": z, "p": 1 / (1 + np.exp(-logit))}

    def score(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not self.weights or not len(sizes):
            return np.full(len(sizes), 0.5)
        return self.forward(features, sizes)["p"].astype(np.float64)


def _gradients(model: AttentionModel, features: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    w, f = model.weights, model.forward(features, sizes)
    bag, a, h = f["bag"], f["attention"], f["h"]
    d_logit = (f["p"] - labels) / len(labels)
    d_z = d_logit[:, None] * w["score"][None, :]
    d_a = (d_z[bag] * h).sum(axis=1)
    d_energy = a * (d_a - np.add.reduceat(a * d_a, f["starts"])[bag])
    d_gate = d_energy[:, None] * w["attend"][None, :]
    d_left = d_gate * f["right"] * (1 - f["left"] ** 2)
    d_right = d_gate * f["left"] * f["right"] * (1 - f["right"])
    d_h = a[:, None] * d_z[bag] + d_left @ w["tanh"].T + d_right @ w["sigmoid"].T
    d_in = d_h * (1 - h**2)
    return {
        "encode": f["x"].T @ d_in,
        "encode_bias": d_in.sum(axis=0),
        "tanh": h.T @ d_left,
        "sigmoid": h.T @ d_right,
        "attend": f["gate"].T @ d_energy,
        "score": f["z"].T @ d_logit,
        "score_bias": d_logit.sum(keepdims=True),
    }


def train(features: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> AttentionModel:
    """Adam on bags in seeded order."""
    dice = np.random.default_rng(SEED)
    shapes = {"encode": (FEATURES, HIDDEN), "encode_bias": (HIDDEN,), "tanh": (HIDDEN, GATE), "sigmoid": (HIDDEN, GATE),
              "attend": (GATE,), "score": (HIDDEN,), "score_bias": (1,)}
    weights = {k: dice.normal(0, 1 / np.sqrt(s[0]), s) if "bias" not in k else np.zeros(s) for k, s in shapes.items()}
    model = AttentionModel(features.mean(axis=0), features.std(axis=0) + 1e-3, weights)
    first = {k: np.zeros(s) for k, s in shapes.items()}
    second = {k: np.zeros(s) for k, s in shapes.items()}
    starts, step = np.concatenate([[0], np.cumsum(sizes)]), 0
    for _ in range(EPOCHS):
        order = dice.permutation(len(sizes))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            rows = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            found = _gradients(model, features[rows], sizes[chosen], labels[chosen])
            step += 1
            for k, gradient in found.items():
                gradient = gradient + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * gradient
                second[k] = 0.999 * second[k] + 0.001 * gradient**2
                fixed = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                weights[k] -= RATE * fixed
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        features, sizes = encode_bags(batch.column(1).to_pylist())
        ends = np.cumsum(sizes)
        bags = [features[end - size : end].tobytes() for size, end in zip(sizes, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary()), batch.column(2)],
            names=["doc_id", "size", "bag", "label"],
        )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_passages: int = SAMPLE_PASSAGES,
) -> AttentionModel:
    sample = labelled_sample(known_labels(labels, id_col, label_col), sample_rows)
    untrained = AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), {})
    if len({label for _, label in sample}) < 2:
        return untrained
    texts = sample_documents(docs, sample, id_col, text_col)
    bags = texts.mapInArrow(_bags, "doc_id bigint, size bigint, bag binary, label bigint")
    one = bags.groupBy("doc_id", "label").agg(F.min(F.struct("bag", "size")).alias("least"))
    one = checkpointed(one.select("doc_id", "label", "least.size", "least.bag"))
    # In order of the sample's hash, which knows no size; at most two ids per SAMPLE_ROWS.
    sizes = one.select("doc_id", "label", "size").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    room, chosen = sample_passages, []
    for row in sizes:
        if row.size <= room:
            room -= row.size
            chosen.append(row.doc_id)
    # Sorted, so that training repeats.
    rows = sorted((row.label, bytes(row.bag)) for row in one.where(F.col("doc_id").isin(chosen)).collect())
    if len({label for label, _ in rows}) < 2:
        return untrained
    each = [np.frombuffer(bag, np.float32).reshape(-1, FEATURES) for _, bag in rows]
    return train(np.concatenate(each).astype(np.float64), np.array([len(x) for x in each]), np.array([y for y, _ in rows], float))


def _score(shared):
    """The last column is the text; its score takes its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            features, sizes = encode_bags(batch.column(batch.num_columns - 1).to_pylist())
            columns = [*batch.columns[:-1], pa.array(model.score(features, sizes), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_score"])

    return run


def score_quality(docs: DataFrame, model: AttentionModel, *, text_col: str = "text") -> DataFrame:
    """The documents with `quality_score`, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wide = packed(docs, _text=F.col(f"`{text_col}`"))
    schema = T.StructType(wide.schema.fields[:1]).add("_score", T.DoubleType())
    return unpacked(wide.mapInArrow(_score(shared), schema), docs.columns, {"quality_score": F.col("_score")})
