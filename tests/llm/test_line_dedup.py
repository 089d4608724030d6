"""Line dedup against a loop, over batches and levels of any number."""

import random
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from tradeloom.llm import line_dedup
from tradeloom.llm.line_dedup import dedup_lines
from tradeloom.llm.sql import LINE_DEDUP

SPACES = " \t\n\x0b\x0c\r"


def plain(rows, min_docs=3, min_chars=20):
    holders = defaultdict(set)
    keys = []
    for doc, text in rows:
        own = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES)) for line in (text or "").split("\n")]
        keys.append(own)
        for key in {k for k in own if len(k) >= min_chars}:
            holders[key].add(doc)
    largest = {k: max((d for d in docs if d is not None), default=None) for k, docs in holders.items() if len(docs) >= min_docs}
    out = []
    for (doc, text), own in zip(rows, keys):
        lines = (text or "").split("\n")
        kept = [line for line, key in zip(lines, own) if key not in largest or largest[key] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(docs, **options):
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in dedup_lines(docs, **options).collect()], key=str)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (5, 3)])
def test_equals_loop(frame, batches, fanout):
    dice = random.Random(batches)
    pool = [f"Shared line number {i} with some ß é text" for i in range(12)] + ["short", "", "   ", "20 code points here!", "19 code points here"]
    rows = []
    for doc in range(60):
        lines = [dice.choice(pool) for _ in range(dice.randrange(6))] + [f"own line of document {doc}"]
        lines = [dice.choice(["", "\t ", "  "]) + (line.upper() if line.isascii() and dice.random() < 0.4 else line) + dice.choice(["", "\r"]) for line in lines]
        rows.append((doc * 7 % 61, "\n".join(lines)))
    docs = frame("doc_id bigint, text string", *rows)
    assert result(docs, batches=batches, fanout=fanout) == plain(rows)


def test_odd_rows(frame):
    line = "a line that is long enough"
    rows = [(None, line), (3, line), (3, line), (2, f"{line}\nx"), (1, None), (0, ""), (9, f"{line}\n" * 3 + "y" * 50_000)]
    docs = frame("doc_id bigint, text string, key string, n_lines string, drops int", *[(*row, "k", "l", 1) for row in rows])
    found = dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "key", "drops", "n_lines", "n_dropped"]
    assert result(docs) == plain(rows)
    equal = frame("doc_id bigint, text string", (5, line), (5, line), (5, line), (6, line), (6, line))
    assert [r.n_dropped for r in dedup_lines(equal).collect()] == [0] * 5
    unnamed = frame("doc_id bigint, text string", (None, line), (None, line), (None, line))
    assert [r.n_dropped for r in dedup_lines(unnamed).collect()] == [0, 0, 0]


def test_empty_table(frame):
    assert dedup_lines(frame("doc_id bigint, text string")).collect() == []


def test_runs_are_cleaned_up(spark, frame):
    before = {t.name for t in spark.catalog.listTables()}
    dedup_lines(frame("doc_id bigint, text string", (1, "a line that is long enough"))).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_repeated_ids_count_as_the_sql_counts_them(frame):
    """One line per row; an id that repeats is one document, in whichever rows it lies."""
    dice = random.Random(3)
    lines = [f"a shared line of number {i}" for i in range(6)]
    rows = [(dice.randrange(6), line) for line in lines[:5] for _ in range(4)] + [(1, lines[5]), (1, lines[5]), (2, lines[5])]
    documents = pa.table({"doc_id": [doc for doc, _ in rows], "text": [line for _, line in rows]})  # noqa: F841
    expected = dict(duckdb.sql(f"select doc_id, n_dropped from ({LINE_DEDUP})").fetchall())
    for batches in (1, 3):
        out, dropped = dedup_lines(frame("doc_id bigint, text string", *rows), batches=batches), defaultdict(int)
        for row in out.collect():
            dropped[row.doc_id] += row.n_dropped
        assert dropped == expected and 0 < sum(expected.values()) < len(rows)


def test_many_documents_in_one_sum(frame):
    rows = [(doc % 700, "the same line in every document" + "!" * (doc % 5)) for doc in range(2000)]
    docs = frame("doc_id bigint, text string", *rows).coalesce(1)
    assert result(docs) == plain(rows)


def test_nothing_is_left_after_a_failure(spark, frame, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}

    def failing(self, batch):
        raise RuntimeError("lost")

    monkeypatch.setattr(line_dedup.SortedRuns, "add", failing)
    with pytest.raises(RuntimeError, match="lost"):
        dedup_lines(frame("doc_id bigint, text string", (1, "a line that is long enough")))
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("keys, bits", [(0, 1 << 23), (1 << 19, 1 << 23), ((1 << 19) + 1, 1 << 24), (1 << 40, 1 << 27)])
def test_the_filter_follows_the_settled_hashes(keys, bits):
    assert line_dedup.filter_size(keys) == bits


def test_one_file_per_bucket_and_no_run_written_for_nothing(spark, frame, monkeypatch):
    files, drop = {}, line_dedup.SortedRuns.drop

    def counted(self, name):
        if spark.catalog.tableExists(name):
            files[name] = len(spark.table(name).inputFiles())
        drop(self, name)

    monkeypatch.setattr(line_dedup.SortedRuns, "drop", counted)
    rows = [(doc, "\n".join(f"a line of number {(doc * k) % 300} in a text" for k in range(5))) for doc in range(400)]
    assert result(frame("doc_id bigint, text string", *rows), batches=4, fanout=2) == plain(rows)
    assert len(files) == 6  # the slices, a run of each batch, the first two runs compacted
    assert max(files.values()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
