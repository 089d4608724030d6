"""Pieces against all cuts of short texts, cuts by the public library, and round trips."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tradeloom.llm import pieces
from tradeloom.llm import queries as q

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def segmenter():
    return pieces.Segmenter(pieces.load_vocabulary(pieces.MODEL))


@pytest.fixture(scope="module")
def unigram():
    """The same pieces and scores, with the model type set to unigram."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def all_cuts(text, table, unknown):
    """Best sum over every way to cut the text into pieces or unknown characters."""
    if not text:
        return 0.0
    found = []
    for length in range(1, len(text) + 1):
        score = table.get(text[:length], unknown if length == 1 else None)
        if score is not None:
            found.append(score + all_cuts(text[length:], table, unknown))
    return max(found)


def test_never_worse_than_library(spark, segmenter, unigram):
    """The library's cut of a line is one of those that the search compares."""
    for row in q.read(spark, DIRECTORY, "documents").collect():
        for line in row.text.split("\n"):
            own, other = segmenter.encode(line).tolist(), unigram.encode(line)
            assert unigram.decode(own) == line == segmenter.decode(other)
            assert sum(segmenter.scores[i] for i in own) >= sum(segmenter.scores[i] for i in other)


def test_best_of_all_cuts(segmenter):
    table = {p: s for p, s in zip(segmenter.pieces, segmenter.scores) if p is not None}
    dice = random.Random(5)
    for _ in range(60):
        text = pieces.MARK + "".join(dice.choice("thneio ßé☃") for _ in range(dice.randrange(1, 9))).replace(" ", pieces.MARK)
        ids = segmenter.segment(text)
        score, run = 0.0, bytearray()
        for i in ids:
            if i in segmenter.bytes_by_id:
                run.append(segmenter.bytes_by_id[i])
            else:
                score += segmenter.scores[i]
        score += segmenter.unknown_score * len(run.decode())
        assert score == all_cuts(text, table, segmenter.unknown_score)


def test_splitting_changes_nothing(segmenter):
    for text in ["a b  c\n\nd", " lead", "tail ", "x\ny z", "\n", "  "]:
        whole = segmenter.segment(pieces.MARK + text.replace(" ", pieces.MARK))
        assert tuple(segmenter.encode(text)) == whole


def test_round_trip_of_odd_texts(segmenter):
    dice = random.Random(3)
    texts = ["", " ", "\n", "a\tb", "☃ \U0001f600é", "\x00\x01", "the " * 30_000, "\U0010ffff" * 3, "<s> <unk> <0x41>"]
    texts += ["".join(chr(dice.choice([32, 10, dice.randrange(1, 0x2000)])) for _ in range(50)) for _ in range(200)]
    for text in texts:
        assert segmenter.decode(segmenter.encode(text).tolist()) == text


def test_decoding_odd_ids(segmenter):
    assert segmenter.decode([]) == ""
    assert segmenter.decode([0, 1, 2, -5, 10**9]) == ""
    assert segmenter.decode([segmenter.byte_ids[0xC3]]) == "�"


def test_double_array_holds_its_keys():
    dice = random.Random(1)
    keys = {bytes(dice.choice(b"abc\xff\x00") for _ in range(dice.randrange(1, 7))): n for n in range(400)}
    base, check, value = pieces.double_array(keys)

    def look_up(key):
        state = pieces.ROOT
        for byte in key:
            child = base[state] + byte
            if check[child] != state:
                return -1
            state = child
        return value[state]

    assert all(look_up(key) == n for key, n in keys.items())
    assert all(look_up(key + b"z") == -1 for key in keys)


def test_query_is_exact(spark):
    rows = q.op7_sentencepiece(spark, DIRECTORY)
    assert rows.count() == 200 and rows.where("not exact or n_pieces = 0").count() == 0


def test_odd_rows(frame):
    docs = frame("doc_id bigint, text string, piece_ids int, _in int", (1, None, 5, 6), (2, "", None, 6), (None, "ab", 5, None), (None, "ab", 5, None))
    coded = pieces.decode_pieces(pieces.encode_pieces(docs))
    assert coded.columns == ["doc_id", "text", "_in", "piece_ids", "decoded"]
    rows = sorted((r.doc_id or 0, len(r.piece_ids), r.decoded) for r in coded.collect())
    assert rows == [(0, 1, "ab"), (0, 1, "ab"), (1, 0, ""), (2, 0, "")]
    assert pieces.encode_pieces(docs.where(F.lit(False))).collect() == []


def test_generations_change_nothing(segmenter, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_CHUNKS", 7)
    monkeypatch.setattr(segmenter, "recent", {})
    monkeypatch.setattr(segmenter, "older", {})
    texts = [" ".join(f"word{i * j % 23} {'long' * 30}" for j in range(40)) for i in range(20)] + [None, "", "é\n" * 3]
    ids, ends = segmenter.encode_all(texts)
    whole = [segmenter.segment(pieces.MARK + text.replace(" ", pieces.MARK)) if text else () for text in texts]
    assert [tuple(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])] == whole
    assert segmenter.decode_all(ids, ends) == [text or "" for text in texts]
    assert len(segmenter.recent) <= 7 and len(segmenter.older) <= 7
    assert all(len(chunk) <= pieces.CACHED_LENGTH for chunk in segmenter.recent)


def test_one_pass_equals_two(spark, frame):
    odd = [None, "", " ", "a\n\nb", "▁ x", "é漢🙂" * 300, "x" * 100_000, "same", "same"]
    docs = frame("doc_id int, text string, decoded string", *[(i, text, "old") for i, text in enumerate(odd)])
    docs = docs.unionByName(spark.read.parquet(f"{DIRECTORY}/documents.parquet").select(F.col("doc_id").cast("int"), "text", F.lit("old").alias("decoded")))
    once = pieces.round_trip_pieces(docs)
    twice = pieces.decode_pieces(pieces.encode_pieces(docs))
    assert sorted(once.columns) == sorted(twice.columns)
    assert once.select(twice.columns).exceptAll(twice).count() == 0 and once.count() == docs.count()
    assert pieces.round_trip_pieces(docs.limit(0)).count() == 0
