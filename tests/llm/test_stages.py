"""Every pipeline stage on odd documents and on none."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tapeloom.llm import stages

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, item bigint, _removed string"
LONG = "unbroken" * 300
LINE = " ".join(f"word{n}" for n in range(30))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n ", "en", None, 3), (4, "one", None, "b", 3),
    (5, "one", "en", "b", 3), (5, "one", "en", "b", 3), (None, "two words", "en", "c", 9), (6, LONG, "en", "d", len(LONG)),
    (7, f"{LINE}\nleft\n{LINE}", "en", "e", 5 + 2 * len(LINE) + 1), (8, LINE, "en", "e", len(LINE)),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in ROWS], SCHEMA)


def ids(frame):
    return sorted((r.doc_id or 0) for r in frame.collect())


def test_quality_stage(spark, docs):
    kept = stages.good_quality(spark, docs, SF)
    assert kept.columns == stages.COLUMNS
    assert set(ids(kept)) <= {r[0] or 0 for r in ROWS}


def test_near_duplicate_stage(spark, docs):
    kept = stages.one_of_near_duplicates(spark, docs, SF)
    assert kept.columns == stages.COLUMNS
    # Document 8 is the line that document 7 has twice: 26 of 31 shingles in common.
    assert ids(kept) == [0, 1, 2, 3, 4, 6, 7]


def test_rows_of_one_id_are_told_apart(spark):
    """Unlike texts under one id stay both, near ones do not, and copies without an id go."""
    text = " ".join(f"w{n}" for n in range(100))
    rows = [(1, "other words than those of the next row"), (1, text), (2, f"{text} more"), (None, text), (None, "alone"), (None, "alone"), (3, "x y z"), (3, "x y z")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), 1, "x") for i, t in rows], SCHEMA)
    kept = stages.one_of_near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, "alone"), (1, rows[0][1]), (1, text), (3, "x y z")])


def test_leaks_without_an_id_go_and_namesakes_stay(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, f"before {item} after"), (5, f"{item}"), (5, "a clean text of the same id"), (None, "clean too")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), 1, "x") for i, t in rows], SCHEMA)
    kept = stages.without_benchmark(spark, docs, SF)
    assert sorted(r.text for r in kept.collect()) == ["a clean text of the same id", "clean too"]


def test_paragraph_stage(spark, docs):
    kept = stages.without_repeated_paragraphs(spark, docs, SF)
    assert kept.columns == stages.COLUMNS
    # Nothing is left of document 8; document 7 keeps its first line and the short one.
    assert ids(kept) == [0, 1, 2, 3, 4, 5, 5, 6, 7]
    seven = kept.filter("doc_id = 7").first()
    assert (seven.text, seven.n_chars, seven.source) == (f"{LINE}\nleft", len(LINE) + 5, "e")
    assert kept.filter("doc_id = 1").first().n_chars is None


def test_benchmark_stage(spark, docs):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    leaked = spark.createDataFrame([(9, f"before {item} after", "en", "f", 1, 1, "x")], SCHEMA)
    kept = stages.without_benchmark(spark, docs.unionByName(leaked), SF)
    assert kept.columns == stages.COLUMNS
    assert ids(kept) == sorted(r[0] or 0 for r in ROWS)


def test_token_stage(spark, docs):
    out = stages.tokens(spark, docs, SF)
    assert ids(out) == sorted(r[0] or 0 for r in ROWS)
    assert {(r.doc_id, r.n_tokens) for r in out.collect()} >= {(1, 0), (2, 0), (4, 1)}


def test_stages_on_nothing(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
