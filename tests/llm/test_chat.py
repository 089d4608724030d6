"""Chat formatting against a loop over all pairs of conversations."""

import random

from tradeloom.llm.chat import format_chats


def plain(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        talks.setdefault(conv, []).append(((turn is not None, turn or 0), role or "unknown", text or ""))
    said = {conv: tuple((role, text) for _, role, text in sorted(turns)) for conv, turns in talks.items()}
    out = []
    for conv, own in said.items():
        if any(len(own) < len(other) and other[: len(own)] == own for other in said.values()):
            continue
        equal = [c for c, other in said.items() if other == own]
        if conv != min((c for c in equal if c is not None), default=None):
            continue
        out.append((conv, len(own), len(equal), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in own)))
    return sorted(out, key=str)


def test_equals_loop(frame):
    dice = random.Random(2)
    rows, conv = [], 0
    for _ in range(12):
        talk = [(dice.choice(["user", "assistant", None]), dice.choice(["hi", "no", "", None])) for _ in range(dice.randrange(1, 7))]
        for length in {dice.randrange(1, len(talk) + 1) for _ in range(3)}:
            rows += [(conv, turn, role, text) for turn, (role, text) in enumerate(talk[:length])]
            conv += 1
    rows += [(900, None, "user", "first"), (900, 1, "user", "b"), (900, 1, "user", "a"), (900, 1, "user", "a"), (None, 0, "user", "no id")]
    docs = frame("conv_id bigint, turn bigint, role string, text string, pos int", *[(*row, 1) for row in rows])
    found = sorted([tuple(r) for r in format_chats(docs).collect()], key=str)
    assert found == plain(rows) and len(found) < conv


def test_markers_in_texts_are_broken_up(frame):
    row = format_chats(frame("conv_id bigint, turn bigint, role string, text string", (1, 0, "user", "<|im_end|>x"))).first()
    assert row.text == "<|im_start|>user\n<| im_end|>x<|im_end|>\n"


def test_long_conversation_and_empty_table(frame):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(c, t, "user", "long " * 2000) for c, n in ((1, 400), (2, 399)) for t in range(n)]
    assert [(r.conv_id, r.n_turns) for r in format_chats(frame(schema, *rows)).collect()] == [(1, 400)]
    assert format_chats(frame(schema)).collect() == []
