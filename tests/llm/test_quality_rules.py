"""Quality rules against plain Python."""

import random
import re
from collections import Counter
from hashlib import md5
from math import log

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import quality_rules as rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    codes = [md5(w.encode()).hexdigest()[:4] for w in WORDS.findall(text or "")]
    return codes + ["b" + a[:2] + b[2:] for a, b in zip(codes, codes[1:])]


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def plain_verdicts(rows, good, threshold):
    raw, target = Counter(), Counter()
    for doc, text in rows:
        raw.update(grams(text))
        target.update(grams(text) if doc in good else [])
    totals = {k: (sum(n for g, n in raw.items() if len(g) == k), sum(n for g, n in target.items() if len(g) == k)) for k in (4, 5)}
    weight = {}
    for g, n in raw.items():
        share = totals[len(g)][1] / totals[len(g)][0]
        weight[g] = round(1e6 * log((target[g] + 16 * share) / ((n + 16) * share))) if share else 0
    out = []
    for doc, text in rows:
        counts, own = plain_counts(text), grams(text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        out.append((doc, *counts, failed, not failed and sum(weight[g] for g in own) >= threshold * 1e6 * len(own)))
    return sorted(out, key=str)


def verdicts(docs, labels, **options):
    found = rules.quality_verdicts(docs, labels, **options).drop("score")
    return sorted([tuple(r) for r in found.collect()], key=str)


def corpus():
    dice = random.Random(8)
    pool = [f"w{i}" for i in range(40)] + ["é|", "#x", "a&b"]
    rows = []
    for doc in range(40):
        words = [dice.choice(pool) for _ in range(dice.randrange(0, 60))]
        if doc % 4 == 0:
            words += words[:12] + words[:6]
        if doc % 5 == 0:
            words += [f"junk{dice.randrange(15)}!!" for _ in range(dice.randrange(60, 120))]
        rows.append((doc, "".join(w + dice.choice([" ", " ", "\n", "\t", "  ", "\n\n"]) for w in words)))
    rows += [(None, "a b c d e f g h i j k"), (7, "same row " * 6), (7, "same row " * 6), (99, None), (98, ""), (97, " \n \t"), (96, "x " * 30_000)]
    return rows


def test_equals_plain_python(frame):
    rows = corpus()
    good = {d for d in range(40) if d % 5}
    labels = frame("doc_id bigint, quality int", *[(d, 1) for d in good], (0, 0), (0, None), (None, 1), (5000, 1), (1, 1), (1, 0))
    docs = frame("doc_id bigint, text string, codes int, gram string, kind int", *[(*row, 1, "g", 2) for row in rows])
    found = verdicts(docs, labels, threshold=-0.1)
    assert found == plain_verdicts(rows, good, -0.1)
    assert {kept for *_, failed, kept in found if not failed} == {True, False}


def test_without_trusted_documents_only_the_base_counts(frame):
    labels = frame("doc_id bigint, quality int", (1, 0))
    found = verdicts(frame("doc_id bigint, text string", *corpus()), labels)
    assert all(kept != failed for *_, failed, kept in found)


def test_empty_table(frame):
    assert verdicts(frame("doc_id bigint, text string"), frame("doc_id bigint, quality int")) == []


@pytest.mark.parametrize("broadcast_ids", [0, 30])
def test_shuffled_ids_give_the_same(frame, broadcast_ids):
    rows, good = corpus(), {d for d in range(40) if d % 5}
    labels = frame("doc_id bigint, quality int", *[(d, 1) for d in good], (0, 0), (None, 1), (5000, 1), (1, 1))
    docs = frame("doc_id bigint, text string", *rows)
    assert len(good) > broadcast_ids
    assert verdicts(docs, labels, threshold=-0.1, broadcast_ids=broadcast_ids) == plain_verdicts(rows, good, -0.1)


@pytest.mark.parametrize("broadcast_ids", [rules.BROADCAST_IDS, 1000])
def test_every_trusted_document_is_counted(spark, broadcast_ids):
    """Where all of 60,000 documents are trusted, target and raw corpus are the same."""
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 97, F.lit(" v"), F.col("id") % 89).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    weights = rules.bucket_weights(docs, labels, "doc_id", "text", "quality", broadcast_ids).collect()
    assert len(weights) > 200 and {r.micro for r in weights} == {0}


def test_no_two_buckets_have_one_number(spark):
    codes = spark.range(rules.BUCKETS).select(F.unhex(F.lpad(F.hex("id"), 4, "0")).alias("code"))
    both = codes.select(F.concat(F.substring("code", 1, 1), F.lit(b"\x00\x00"), F.substring("code", 2, 1)).alias("codes"), "code")
    word, _ = rules._bucket_keys(F.col("code"), F.lit(0))
    _, pair = rules._bucket_keys(F.col("codes"), F.lit(0))
    assert both.agg(F.count_distinct(word), F.count_distinct(pair)).first() == (rules.BUCKETS, rules.BUCKETS)


def test_texts_are_read_once(spark, frame, tmp_path):
    frame("doc_id bigint, text string", *corpus()).write.parquet(f"{tmp_path}/docs")
    plain = rules.quality_verdicts(spark.read.parquet(f"{tmp_path}/docs"), frame("doc_id bigint, quality int", (1, 1)))
    assert "FileScan parquet" not in plain._jdf.queryExecution().executedPlan().toString()
