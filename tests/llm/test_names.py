"""Stages on tables whose extra columns have the operators' own names, dots or upper case."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL

NAMES = ["_source", "_draws", "_below", "_searched", "_keep", "_row", "_doc", "_text", "a.b", "in_0", "fp", "copy", "mix_key", "n words", "root", "_ID"]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return base.select("*", *[base["doc_id"].alias(n) for n in NAMES])


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:3]])
def test_filters_keep_every_column(spark, docs, stage):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    want = {tuple(r) for r in stage(spark, plain, SF_SMALL).collect()}
    got = stage(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {tuple(r)[:5] for r in rows} == want and all(set(tuple(r)[5:]) == {r[0]} for r in rows)


def test_mixing_replaces_only_its_results(spark, docs):
    from tradestar.llm.mixing import replicate

    got = replicate(docs)
    assert got.columns == [c for c in docs.columns if c not in ("copy", "mix_key")] + ["copy", "n_copies", "mix_key"]
    plain = sorted((r.doc_id, r.copy) for r in replicate(docs.select("doc_id", "text", "lang", "source", "n_chars")).collect())
    assert sorted((r.doc_id, r.copy) for r in got.collect()) == plain
