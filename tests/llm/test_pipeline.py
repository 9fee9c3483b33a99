"""The pipeline against its parts worked out by hand, on the smallest tables."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from test_jaccard_join import brute

import __spark_entry__ as entries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_stages(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "weighted_mixing", "token_output"]
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_language_keeps_clean_documents(tables):
    before, after = ({r["doc_id"] for r in t.collect()} for t in tables[:2])
    assert after <= before and len(after) >= 0.99 * len(before)


def test_one_document_of_each_group_stays(tables):
    rows = [(r["doc_id"], r["text"]) for r in tables[1].collect()]
    assert sorted(r["doc_id"] for r in tables[2].collect()) == sorted({root for _, root in brute(rows).values()})


def test_benchmark_goes(spark, tables):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in tables[2].collect() if not any(100 * len(i & shingles(r["text"])) >= 80 * len(i) for i in items)]
    assert sorted(r["doc_id"] for r in tables[3].collect()) == sorted(clean) and len(clean) < tables[2].count()


def test_mix_takes_its_budget(tables):
    words = lambda t: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in t.collect())
    whole, taken = words(tables[3]), words(tables[4])
    assert 0.85 * whole <= taken <= whole
    assert {r["doc_id"] for r in tables[4].collect()} <= {r["doc_id"] for r in tables[3].collect()}


def test_tokens_of_all_that_is_mixed(tables):
    rows = sorted(tables[5].collect(), key=lambda r: r["start"])
    assert sorted(r["doc_id"] for r in rows) == [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in tables[4].collect())
    start = 0
    for r in rows:
        assert r["start"] == start and r["n_tokens"] > 1
        start += r["n_tokens"]


def test_run_is_registered_and_gives_the_same(spark, tables):
    assert entries.queries()["pipeline"] is corpus_pipeline.run
    found = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert found == sorted(map(tuple, tables[5].collect()))
