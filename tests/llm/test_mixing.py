"""Hierarchical budgets against a recursive loop, and the prefix of a leaf against a sort."""

import random
from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import mixing


def levels():
    return {"domain": F.col("d"), "lang": F.col("l"), "source": F.col("s")}


def plain_fill(children, given):
    """{name: (cap, weight)} to whole budgets; full children give back until nobody is full."""
    budget, open_ones = {}, dict(children)
    while open_ones:
        left = given - sum(budget.values())
        level = Fraction(left, sum(w for _, w in open_ones.values()))
        full = {name: cap for name, (cap, w) in open_ones.items() if cap <= w * level}
        if not full:
            budget |= {name: int(w * level) for name, (_, w) in open_ones.items()}
            break
        budget |= full
        open_ones = {name: x for name, x in open_ones.items() if name not in full}
    return budget


def plain_mix(rows, weights, epochs, percent, seed):
    leaves = defaultdict(int)
    for _, d, lang, s, text in rows:
        leaves[d, lang, s] += len((text or "").split())
    total = sum(leaves.values())
    budgets = {(): min(total * percent // 100, total * epochs)}
    for level, name in enumerate(("domain", "lang", "source")):
        below = defaultdict(dict)
        for path, tokens in leaves.items():
            key = path[: level + 1]
            cap, w = below[key[:-1]].get(key, (0, max(1, weights.get(name, {}).get(key[-1], 1))))
            below[key[:-1]][key] = (cap + tokens * epochs, w)
        budgets = {key: b for parent, children in below.items() for key, b in plain_fill(children, budgets[parent]).items()}
    out = []
    for path, tokens in leaves.items():
        full, rest = divmod(budgets[path], max(tokens, 1))
        own = [(md5((f"{seed}:{full}" + (f":{r[0]}" if r[0] is not None else "")).encode()).hexdigest(), r) for r in rows if r[1:4] == path]
        for h, r in own:
            before = sum(len((x[4] or "").split()) for g, x in own if g < h)
            out.append((r[0], full + (before < rest)))
    return sorted(out, key=str)


@pytest.mark.parametrize("epochs, percent", [(1, 60), (2, 100), (3, 250)])
def test_equals_loop(frame, epochs, percent):
    dice = random.Random(percent)
    rows = []
    for doc in range(150):
        domain = dice.choice(["web", "web", "web", "books", "forum"])
        rows.append((doc, domain, dice.choice(["en", "en", "de", None]), f"s{dice.randrange(3)}", "w " * dice.randrange(0, 40)))
    rows += [(None, "web", "en", "s0", "a b c"), (7, "web", "en", "s0", "a b"), (7, "web", "en", "s0", "a b"), (500, None, None, None, None)]
    docs = frame("doc_id bigint, d string, l string, s string, text string", *rows)
    weights = {"domain": {"web": 5, "books": 30, "forum": 2}, "lang": {"en": 3}}
    out = mixing.mix_sources(docs, weights, levels(), max_epochs=epochs, budget_percent=percent, seed=3)
    assert out.columns == [*docs.columns, "n_copies"]
    found = sorted([(r.doc_id, r.n_copies) for r in out.collect()], key=str)
    assert found == plain_mix(rows, weights, epochs, percent, 3)
    assert len({n for _, n in found}) > 1


def test_joins_by_shuffle_give_the_same(frame, monkeypatch):
    docs = frame("doc_id bigint, source string, lang string, text string, _md5 int", *[(i, f"s{i % 4}", "en", "a b c", 1) for i in range(60)])
    expected = sorted(r.n_copies for r in mixing.mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    assert sorted(r.n_copies for r in mixing.mix_sources(docs).collect()) == expected


def test_empty_and_blank(frame):
    schema = "doc_id bigint, source string, lang string, text string, n_copies string"
    assert mixing.mix_sources(frame(schema)).collect() == []
    out = mixing.mix_sources(frame(schema, (1, None, None, None, "x"), (2, "s1", "en", " \t ", "x")))
    assert [r.n_copies for r in out.collect()] == [0, 0] and len(out.columns) == 5


def test_words_are_counted_by_ascii_space(frame):
    row = frame("t string", ("\x0ba b \r\n c\x0c",)).select(mixing.count_words(F.col("t")).alias("n")).first()
    assert row.n == 2
