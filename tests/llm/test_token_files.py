"""Bit packing by an exact round trip, and token files against the tokenizer run over whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.conftest import as_dicts
from tradeloom.llm.bit_packing import BLOCK_IDS, bits_for, pack, segment_bytes, segments, unpack
from tradeloom.llm.queries import op11_token_files
from tradeloom.llm.token_files import read_tokens, write_tokens
from tradeloom.llm.word_coder import WordCoder, coder_for

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    "", " ", "\n\t \x0b\x0c\r", "Hello,  World!!\nIt's  don't DON'T 'S ''s word' \x1c\x1d a\x85b c d　e", "<|endoftext|>a <|ENDOFTEXT|> b<|startoftext|>c",
    "ÀÉÿß ÖZIL Œuvre İstanbul ΣΑΣ éa ́b ½² ١٢٣ a1b22 ###$$$ x--- ​‍ \x00\x01 a\xadb µm × ª", "日本語 テスト 😀😀 👩‍👩‍👧", "l'ess qu'il 've 'll're'm", "x" * 3000, "ab" * 40 + "," * 90,
]


def whole(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def plain(rows):
    """(doc_id, text) in file order to what the query returns, by the tokenizer and zlib."""
    start, out = 0, []
    for (doc_id, _), ids in zip(rows, whole([text for _, text in rows]), strict=True):
        data = np.array([*ids, 2], "<u4").tobytes()
        out.append((doc_id, start, len(ids) + 1, zlib.crc32(data)))
        start += len(ids) + 1
    return out


@pytest.mark.parametrize("bits", [1, 2, 3, 7, 8, 9, 13, 16, 17, 24, 31, 32])
def test_packing_round_trip(bits):
    dice = np.random.default_rng(bits)
    for size in (0, 1, 7, 8, 9, 1000, 4097):
        ids = dice.integers(0, 1 << bits, size, dtype=np.uint64).astype(np.uint32)
        packed = pack(ids, bits)
        assert len(packed) == -(-size // 8) * bits
        assert (unpack(packed, size, bits) == ids).all()
        # A loop over single bits says the same.
        number = int.from_bytes(packed, "little")
        assert all(number >> (i * bits) & ((1 << bits) - 1) == x for i, x in enumerate(ids.tolist()[:20]))


def test_too_large_id_is_an_error():
    with pytest.raises(ValueError):
        pack(np.array([8], np.uint32), 3)
    assert [bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_segments_give_any_range():
    dice = np.random.default_rng(1)
    ids = dice.integers(0, 5000, 10_000).astype(np.uint32)
    lengths = np.array([0, 3, 5000, 0, 4997])
    data = b"".join(segment_bytes([None, -5, 7, 7, 9], lengths, ids, 4, start, 13) + b"\n" for start in (0, 10_000))
    first, second = segments(data)
    assert (first.start, second.start, first.n_ids) == (0, 10_000, 10_000)
    assert first.named.tolist() == [False, True, True, True, True] and first.doc_ids.tolist()[1:] == [-5, 7, 7, 9]
    for begin, end in [(0, 10_000), (0, 0), (5, 6), (BLOCK_IDS - 1, BLOCK_IDS + 1), (BLOCK_IDS, 2 * BLOCK_IDS), (9_990, 10_000)]:
        assert (second.ids(begin, end) == ids[begin:end]).all()
    assert [len(second.document(i)) for i in range(5)] == lengths.tolist()
    assert (second.document(4) == ids[5003:]).all()


def test_parts_code_like_whole_texts():
    coder = WordCoder(VOCABULARY)
    assert coder.separates
    dice = random.Random(3)
    pieces = ["word", "Ärger", "naïve", "don't", ",", "...", "'", "\n", "  ", "\t", "1984", "x²", "<|endoftext|>", "é", "é", "Œ", "$", "-", "日", " ", "ſ", "K", "'S"]
    texts = ODD_TEXTS + ["".join(dice.choices(pieces, k=dice.randrange(1, 40))) for _ in range(3000)]
    for _ in range(2):  # the second time from what is kept
        ids, counts = coder.encode(pa.array(texts + [None]))
        found = np.split(ids, np.cumsum(counts)[:-1])
        assert [x.tolist() for x in found] == [*whole(texts), []]
    coder.separates = False
    ids, counts = coder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole(texts)


def test_generations_stay_small(monkeypatch):
    monkeypatch.setattr("tradeloom.llm.word_coder.CACHED_PARTS", 10)
    coder = WordCoder(VOCABULARY)
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}xyz" for j in range(30)) for i in range(20)]
    ids, counts = coder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole(texts)
    assert len(coder.recent) <= 10 and len(coder.older) <= 10


def test_other_vocabularies_take_the_whole_text():
    assert not coder_for(public_tokenizers.path("byte_bpe_50k.json")).separates


def test_query_equals_plain(spark):
    directory = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = sorted(tuple(r) for r in op11_token_files(spark, directory).collect())
    assert found == plain([tuple(r) for r in rows])


def test_odd_rows(spark, tmp_path):
    rows = [(i, text) for i, text in enumerate(ODD_TEXTS)] + [(3, None), (-(1 << 63), "low"), (100, "word " * 50_000), (101, "a" * 1_000_000)]
    docs = spark.createDataFrame([(text, i, 5, b"x") for i, text in rows], "text string, doc_id bigint, n_tokens int, ids binary").repartition(4)
    docs.write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    write_tokens(stored, f"{tmp_path}/out", files=3)
    out = read_tokens(spark, f"{tmp_path}/out")
    found = sorted(as_dicts(out), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted(i for i, _ in rows)
    texts = {i: text for i, text in rows if i != 3}
    for row in found:
        ids = np.frombuffer(row["ids"], "<u4")
        assert len(ids) == row["n_tokens"] and ids[-1] == 2
        if row["doc_id"] != 3:
            assert ids[:-1].tolist() == whole([texts[row["doc_id"]]])[0]
    assert [r["start"] for r in found] == np.cumsum([0] + [r["n_tokens"] for r in found])[:-1].tolist()
    assert len(list((tmp_path / "out" / "tokens").glob("part-*.txt"))) == 3


def test_hot_and_null_ids_fill_several_files(spark, tmp_path):
    rows = [(7 if i % 2 else None if i % 3 else i, f"text number {i}") for i in range(600)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8).write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    write_tokens(stored, f"{tmp_path}/out", files=8)
    found = sorted(as_dicts(read_tokens(spark, f"{tmp_path}/out")), key=lambda r: r["start"])
    order = [r["doc_id"] for r in found]
    assert order == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert sorted(r["n_tokens"] for r in found) == sorted(len(x) + 1 for x in whole([t for _, t in rows]))
    files = [list(segments(path.read_bytes())) for path in (tmp_path / "out" / "tokens").glob("part-*")]
    assert sum(any(7 in part.doc_ids for part in file) for file in files) >= 3


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    write_tokens(docs, f"{tmp_path}/out")
    assert read_tokens(spark, f"{tmp_path}/out").collect() == []
