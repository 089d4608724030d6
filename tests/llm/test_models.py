"""The two learned scores: parts against plain versions, accuracy on held-out documents, odd rows."""

import random
import time
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import quality_model as quality
from tradeloom.llm import queries as q
from tradeloom.llm import toxicity as tox

DIRECTORY = "/root/testdata/sf0.01"


def plain_segments(values):
    """Maximal scoring segments by their definition: the best one (the shortest of these, then the
    earliest), then the same on either side of it."""

    def inside(low, high):
        spans = [(sum(values[a:b]), a - b, -a) for a, b in combinations(range(low, high + 1), 2)]
        best = max(spans, default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a = -best[2]
        b = a - best[1]
        return inside(low, a) + [(a, b - 1, best[0])] + inside(b, high)

    return inside(0, len(values))


@pytest.mark.parametrize("seed", range(25))
def test_segments_equal_their_definition(seed):
    dice = random.Random(seed)
    values = [dice.choice([-0.5] * 3 + [1.25, 2.0, 3.125, 0.703125]) for _ in range(dice.randrange(1, 26))]
    found = tox.maximal_segments([(i, v) for i, v in enumerate(values) if v > 0], 0.5)
    assert [x[:2] for x in found] == sorted(x[:2] for x in plain_segments(values))
    assert sum(s for _, _, s in found) == pytest.approx(sum(s for _, _, s in plain_segments(values)))
    assert max(s for _, _, s in found) == max(s for _, _, s in plain_segments(values)) if found else not plain_segments(values)
    for first, last, score in found:
        assert score == pytest.approx(sum(values[first : last + 1]))
        assert all(sum(values[first:k]) > 0 and sum(values[k : last + 1]) > 0 for k in range(first + 1, last + 1))


@pytest.mark.parametrize("gap", [1, 2, 40, 3])
def test_segments_take_linear_time(gap):
    """Scattered hits, whose candidates never merge, and close ones, which all do."""
    dice = random.Random(gap)
    hits = [(i * gap + (dice.randrange(gap) if gap == 3 else 0), 1.5) for i in range(160_000)]
    began = time.process_time()
    found = tox.maximal_segments(hits, 0.5)
    assert time.process_time() - began < 4  # a few tenths on a machine that is not busy
    assert (len(found) == len(hits)) == (gap == 40)


def test_rate_balances_the_clean_distribution():
    scores, odds = {"a": 4.0, "b": 6.0}, {"a": 1e-3, "b": 1e-4}
    rate = tox._solve_rate(scores, odds)
    total = (1 - 1.1e-3) * np.exp(-rate * tox.DRIFT) + sum(odds[t] * np.exp(rate * (scores[t] - tox.DRIFT)) for t in odds)
    assert total == pytest.approx(1)


def test_held_out_is_a_checksum_of_the_id(spark):
    rows = spark.range(200).select("id", tox.held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def labelled(spark, query, label):
    scored = query(spark, DIRECTORY).join(q.read(spark, DIRECTORY, "labels"), "doc_id").where("held_out")
    return [(r[label], r.predicted, r.score) for r in scored.collect()]


def ranking(rows):
    good, bad = [s for y, _, s in rows if y == 1], [s for y, _, s in rows if y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


def test_toxicity_on_held_out_documents(spark):
    rows = labelled(spark, q.op9_toxicity, "toxic")
    assert ranking(rows) >= 0.85
    assert not any(p for y, p, _ in rows if y == 0)


def test_quality_on_held_out_documents(spark):
    rows = labelled(spark, q.op8_quality_model, "quality")
    assert ranking(rows) >= 0.98
    assert np.mean([y == p for y, p, _ in rows]) >= 0.95


def test_scores_ignore_labels_that_are_held_out(spark):
    docs, labels = q.read(spark, DIRECTORY, "documents").select("doc_id", "text"), q.read(spark, DIRECTORY, "labels")
    flipped = F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    assert tox.fit_toxicity(docs, labels) == tox.fit_toxicity(docs, labels.withColumn("toxic", flipped))


SCHEMA = "doc_id bigint, text string, toxicity string, quality_score int, label int, _score double"


def odd_docs(frame):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "vile word here"), (4, "vile " * 40_000), (4, "vile " * 40_000), (5, "x" * 300_000), (6, "Vile, vile!")]
    return frame(SCHEMA, *[(*row, "t", 1, 2, 0.5) for row in rows])


def test_toxicity_of_odd_rows(frame):
    model = tox.ToxicityModel({"vile": 5.0}, 1.0, 0.01, 0.1)
    out = tox.score_toxicity(odd_docs(frame), model)
    assert out.columns == ["doc_id", "text", "quality_score", "label", "_score", "toxicity", "toxic_passages"]
    found = {r.doc_id: r for r in out.collect()}
    assert [found[i].toxicity for i in (1, 2, 3, 5)] == [0, 0, 0, 0] and found[4].toxicity == 1 and out.count() == 8
    assert [(p.start, p.end) for p in found[6].toxic_passages] == [(0, 10)]
    assert tox.score_toxicity(odd_docs(frame).where("false"), model).collect() == []


def test_models_without_labels(frame):
    docs = odd_docs(frame)
    for labels in (frame("doc_id bigint, toxic int, quality int"), frame("doc_id bigint, toxic int, quality int", (1, 1, 1), (2, None, None), (None, 0, 0))):
        assert {r.toxicity for r in tox.score_toxicity(docs, tox.fit_toxicity(docs, labels)).collect()} == {0.0}
        scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
        assert {r.quality_score for r in scored.collect()} == {0.5}
        assert scored.columns == ["doc_id", "text", "toxicity", "label", "_score", "quality_score"]


def test_gradients_equal_differences():
    dice = np.random.default_rng(0)
    features, sizes, labels = dice.normal(size=(9, quality.FEATURES)), np.array([4, 1, 4]), np.array([1.0, 0.0, 1.0])
    shapes = {"encode": (quality.FEATURES, 5), "encode_bias": (5,), "tanh": (5, 3), "sigmoid": (5, 3), "attend": (3,), "score": (5,), "score_bias": (1,)}
    model = quality.AttentionModel(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), {k: dice.normal(size=s) * 0.3 for k, s in shapes.items()})

    def loss():
        p = model.forward(features, sizes)["p"]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, gradient in quality._gradients(model, features, sizes, labels).items():
        at = tuple(dice.integers(0, n) for n in shapes[name])
        held = model.weights[name][at]
        model.weights[name][at] = held + 1e-5
        above = loss()
        model.weights[name][at] = held - 1e-5
        assert gradient[at] == pytest.approx((above - loss()) / 2e-5, abs=1e-6)
        model.weights[name][at] = held


def test_passages_cover_the_whole_text():
    dice = random.Random(1)
    texts = [" ".join(dice.choice(["ab", "Cd!", "é9"]) for _ in range(n)) for n in (0, 1, 64, 65, 500)] + [None, "w " * 150_000, "y" * 450_000]
    features, sizes = quality.encode_bags(texts)
    assert sizes.tolist()[:6] == [1, 1, 1, 2, 8, 1] and sizes.tolist()[6:] == [2344, 1] and len(features) == sizes.sum()
    words = np.expm1(features[:, quality.GRAM_BUCKETS + len(quality._KINDS) + 2])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    assert np.add.reduceat(words, starts).round().astype(int).tolist()[:7] == [0, 1, 64, 65, 500, 0, 150_000]
    alone = [quality.encode_bags([t])[0] for t in texts[:5]]
    assert np.allclose(np.concatenate(alone), features[: sizes[:5].sum()])


def test_pieces_change_no_passage(monkeypatch):
    """Texts cut into pieces have the passages, to the bit, of texts that are not; also words that never end."""
    monkeypatch.setattr(quality, "LONG_WORD", 50)
    dice = random.Random(5)
    words = ["ab", "Cd!", "é9", "x", "##", "lines"]
    texts = [dice.choice(["", "  "]) + "".join(dice.choice(words) + dice.choice([" ", "\n", " \t "]) for _ in range(n)) for n in (700, 2000, 64, 128)]
    texts += ["é" * 9000, "z" * 3251 + " end", "y" * 6400, " " * 900, "a b c " * 40 + " " * 2000 + "d " * 300, None]
    whole = quality.encode_bags(texts)
    for size in (40, 333, 1000):
        monkeypatch.setattr(quality, "_PIECE_BYTES", size)
        assert any(len(quality._pieces((t or "").encode())) > 3 for t in texts)
        cut = quality.encode_bags(texts)
        assert cut[1].tolist() == whole[1].tolist() and np.array_equal(cut[0], whole[0])


def test_a_long_text_without_white_space_is_many_words():
    began = time.process_time()
    _, sizes = quality.encode_bags(["q" * 20_000_000])
    assert sizes.tolist() == [-(-20_000_000 // (quality.LONG_WORD * quality.PASSAGE_WORDS))]
    assert time.process_time() - began < 60


def test_odd_rows_with_a_trained_model(frame):
    """Whole bags, one row per id, as many as the bound lets in; then scores of odd rows."""
    good, bad = "Plain words that make a fine sentence. ", "## BUY $$ now !!! click %% here "
    ids = [i for i in range(200) if crc32(str(i).encode()) % 3 != 1]
    rows = [(i, (good if i % 2 else bad) * (3 + i)) for i in ids] + [(ids[0], "x" * 300_000)] * 5
    docs = frame("doc_id bigint, text string", *rows)
    labels = frame("doc_id bigint, quality int", *[(i, i % 2) for i in ids])
    model = quality.fit_quality(docs, labels)
    assert model.weights.keys() == quality.fit_quality(docs.repartition(5), labels).weights.keys()
    assert all(np.array_equal(w, quality.fit_quality(docs.repartition(5), labels).weights[k]) for k, w in list(model.weights.items())[:1])
    scored = quality.score_quality(odd_docs(frame), model).collect()
    assert len(scored) == 8 and all(0 <= r.quality_score <= 1 for r in scored)
    empty = {r.quality_score for r in scored if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and len({r.quality_score for r in scored if r.doc_id == 4}) == 1
    ranked = quality.score_quality(frame("doc_id bigint, text string", (1, good * 50), (2, bad * 50)), model)
    found = {r.doc_id: r.quality_score for r in ranked.collect()}
    assert found[1] > 0.5 > found[2]
    assert quality.fit_quality(docs, labels, sample_passages=0).weights == {}


def test_attention_equals_loops():
    """Gated attention, softmax over the bag and the score, written out for one passage after the other."""
    dice = np.random.default_rng(2)
    features, sizes = dice.normal(size=(7, quality.FEATURES)), [3, 1, 3]
    shapes = {"encode": (quality.FEATURES, 4), "encode_bias": (4,), "tanh": (4, 2), "sigmoid": (4, 2), "attend": (2,), "score": (4,), "score_bias": (1,)}
    w = {k: dice.normal(size=s) * 0.2 for k, s in shapes.items()}
    model, at, expected = quality.AttentionModel(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), w), 0, []
    for size in sizes:
        hidden, energy = [], []
        for x in features[at : at + size]:
            h = [np.tanh(sum(x[i] * w["encode"][i, j] for i in range(len(x))) + w["encode_bias"][j]) for j in range(4)]
            gate = [
                np.tanh(sum(h[j] * w["tanh"][j, g] for j in range(4))) / (1 + np.exp(-sum(h[j] * w["sigmoid"][j, g] for j in range(4))))
                for g in range(2)
            ]
            hidden.append(h)
            energy.append(np.exp(sum(gate[g] * w["attend"][g] for g in range(2))))
        z = [sum(e * h[j] for e, h in zip(energy, hidden)) / sum(energy) for j in range(4)]
        expected.append(1 / (1 + np.exp(-(sum(z[j] * w["score"][j] for j in range(4)) + w["score_bias"][0]))))
        at += size
    assert model.score(features, np.array(sizes)) == pytest.approx(expected)


def test_weak_terms_that_come_often_are_toxic():
    """Terms of log-odds below 3 count: six in a text of 340 words are toxic, one is not."""
    model, rest = tox.ToxicityModel({"weak": 1.6, "strong": 4.1}, 2.4, 0.005, 0.12), ["w"] * 55
    texts = {n: (rest + ["weak"]) * n + rest * (6 - n) for n in (0, 1, 6)}
    found = {n: tox.score_words(words, model) for n, words in texts.items()}
    assert found[0] == (0.0, []) and found[1][0] < tox.TOXIC_FROM <= found[6][0]
    assert found[1][1] == [] and [(a, b) for a, b, _ in found[6][1]] == [(55 + 56 * i,) * 2 for i in range(6)]
    assert tox.score_words(rest * 60 + ["weak"] * 1 + rest * 60, model)[0] < tox.TOXIC_FROM
    assert tox.score_words(rest + ["strong"] * 3, model)[0] > 0.99


@pytest.mark.parametrize("number, mean", [(1, 0.01), (3, 0.7), (6, 2.0), (4, 1e-9)])
def test_chance_is_a_poisson_tail(number, mean):
    below = sum(np.exp(-mean) * mean**k / float(np.prod(range(1, k + 1))) for k in range(number))
    assert tox.chance_of(number, mean) == pytest.approx(1 - below, abs=1e-12)
    assert tox.chance_of(number, 0.0) == 0 and tox.chance_of(number, 1e300) == 1


def test_factor_covers_clean_segments_but_for_wrong_labels():
    factor = tox._solve_factor({-1: 100_000, 100: 40, 200: 3, 9000: 1}, 2.0, 1000)
    assert factor == pytest.approx(max(44 / 1e5 * np.exp(2), 4 / 1e5 * np.exp(4)))
    assert tox._solve_factor({-1: 100_000}, 2.0, 1000) == 1e-5 and tox._solve_factor({}, 2.0, 0) == 1


def test_toxic_documents_of_every_language_are_found(spark):
    folder = "/root/testdata/sf0.1"
    scored = q.op9_toxicity(spark, folder).join(q.read(spark, folder, "labels"), "doc_id").where("held_out")
    rows = scored.join(q.read(spark, folder, "documents").select("doc_id", "lang"), "doc_id").select("lang", "toxic", "predicted").collect()
    for lang in ("en", "de", "fr", "es"):
        assert np.mean([r.predicted for r in rows if r.lang == lang and r.toxic == 1]) >= 0.7
        assert np.mean([r.predicted for r in rows if r.lang == lang and r.toxic == 0]) <= 0.02
