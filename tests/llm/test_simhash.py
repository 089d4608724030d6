"""SimHash groups against a loop over all pairs."""

import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tradeloom.llm import queries as q
from tradeloom.llm import simhash
from tradeloom.llm.common import connected_components

DIRECTORY = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(items, linked):
    """Smallest key reachable, by a loop over all pairs."""
    parent = {key: key for key in items}

    def find(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(items)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if linked(items[a], items[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {key: find(key) for key in keys}


def close(a, b):
    return (a ^ b).bit_count() <= 2


def test_query_equals_all_pairs(spark):
    rows = q.op1_simhash_dedup(spark, DIRECTORY).collect()
    texts = {r.doc_id: r.text for r in q.read(spark, DIRECTORY, "documents").collect()}
    fps = {doc: plain_fingerprint(text) for doc, text in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {doc: f"{fp:016x}" for doc, fp in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_groups(fps, close)


def test_fingerprint_equals_sparks_hash(spark):
    hashed = spark.sql("select xxhash64('über die brücke') as h").first().h & (1 << 64) - 1
    assert simhash.fingerprint("Über  die\tBrücke".replace("Ü", "ü")) == hashed == simhash.fingerprint("über die brücke")


@pytest.mark.parametrize("segments", [8, 16, 32])
def test_links_join_all_within_two_bits(spark, segments):
    import random

    dice = random.Random(segments)
    centers = [dice.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    fps = set(centers)
    for center in centers:
        for _ in range(40):
            fps.add(center ^ sum({1 << dice.randrange(64) for _ in range(dice.randrange(6))}))
    signed = {fp: fp - (1 << 64) if fp >> 63 else fp for fp in fps}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    links = {tuple(r) for r in simhash.links_of(frame, segments).select("a", "b").distinct().collect()}
    assert all(close(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in links)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(list(links), "a bigint, b bigint")).collect()}
    expected = plain_groups({s: fp for fp, s in signed.items()}, close)
    assert {s: found.get(s, s) for s in signed.values()} == expected


def test_odd_rows(frame):
    docs = frame(
        "doc_id bigint, text string, fp string, _row int",
        (5, None, "x", 1), (4, "", "x", 2), (9, "One two", "x", 3), (9, "One two", "x", 3), (None, "one two", "y", 4),
        (7, "a b c " * 30_000, "z", None), (None, "alone here", None, None),
    )
    rows = simhash.simhash_groups(docs).collect()
    found = sorted((r.doc_id or -1, r.fingerprint == "0" * 16, r.component_id or -1) for r in rows)
    assert found == [(-1, False, -1), (-1, False, 9), (4, True, 4), (5, True, 4), (7, False, 7), (9, False, 9), (9, False, 9)]
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.fp or "") for r in kept.collect()) == [(-1, ""), (4, "x"), (7, "z"), (9, "x")]


def test_empty_table(frame):
    docs = frame("doc_id bigint, text string")
    assert simhash.simhash_groups(docs).collect() == []
    assert simhash.drop_near_copies(docs).collect() == []


def test_long_chain_is_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected_components(edges).collect()} == {0}
