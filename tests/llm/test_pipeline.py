"""Each stage of the pipeline against the plain version of its operator, on the stage's own input."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_simhash import close, plain_fingerprint, plain_groups
from tradeloom.llm import queries as q

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output rows) of every stage."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, found = q.read(spark, DIRECTORY, "documents"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, DIRECTORY).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs.collect(), out.collect(), docs.columns, out.columns
        docs = out
    return found


def test_columns_stay_until_the_last_stage(stages):
    for name, (_, _, before, after) in stages.items():
        assert before == after or name == pipeline.STAGES[-1][0]


def test_toxic_documents_go(spark, stages):
    before, after, _, _ = stages["toxicity"]
    rejected = {r.doc_id for r in q.op9_toxicity(spark, DIRECTORY).where("predicted = 1").collect()}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == rejected
    assert [r for r in before if r.doc_id not in rejected] == sorted(after, key=lambda r: r.doc_id)


def test_lines_go(stages):
    before, after, _, _ = stages["line_dedup"]
    expected = {doc: text for doc, text, _, _ in plain_lines([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: r.text for r in after} == expected
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_stays(stages):
    before, after, _, _ = stages["simhash"]
    groups = plain_groups({r.doc_id: plain_fingerprint(r.text) for r in before}, close)
    assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
    rows = {r.doc_id: r for r in before}
    assert all(r == rows[r.doc_id] for r in after)


def test_sources_are_mixed(stages):
    before, after, _, _ = stages["mixing"]
    from tests.llm.test_mixing import plain_mix

    domain = {d: name for name, digits in (("web", "0369"), ("books", "147"), ("forum", "258")) for d in digits}
    rows = [(r.doc_id, domain[r.source[-1]], r.lang, r.source, r.text) for r in before]
    weights = {"domain": {"web": 5, "books": 3, "forum": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}
    expected = Counter({doc: n for doc, n in plain_mix(rows, weights, 2, 100, 17) if n})
    assert Counter(r.doc_id for r in after) == expected


def test_pieces_are_exact(stages):
    before, after, _, _ = stages["sentencepiece"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    assert all(r.exact and r.n_pieces == len(r.piece_ids) for r in after)


def test_run_gives_the_last_stage(spark, stages):
    rows = pipeline.run(spark, DIRECTORY).collect()
    assert Counter((r.doc_id, tuple(r.piece_ids)) for r in rows) == Counter((r.doc_id, tuple(r.piece_ids)) for r in stages["sentencepiece"][1])


@pytest.mark.parametrize("keep", [True, False])
def test_odd_rows_pass_every_stage(spark, frame, keep):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity int, n_lines string, n_copies double, fp int, _row int, row int"
    rows = [(None, None, None, None, None), (1, "", "en", "src1", 0), (2, None, None, "src2", 3), (3, "a b c d " * 30_000, "en", None, 1), (3, "a b c d " * 30_000, "en", None, 1)]
    docs = frame(schema, *[(*row, 1, "n", 2.0, 3, 4, 5) for row in rows]).where("true" if keep else "false")
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, DIRECTORY)
        assert out.columns == docs.columns or name == "sentencepiece"
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.count() <= len(rows)
