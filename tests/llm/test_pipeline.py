"""Registered queries against SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from test_decontam import brute as brute_decontam
from test_mixing import brute as brute_mix
from test_simhash import brute_components
from test_weak_quality import brute as brute_measures
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from tradestar.llm import weak_quality as Q
from tradestar.llm.queries import QUERIES, SQL, tokenizer_path


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, said = compare(spark, duck(SF_SMALL), SF_SMALL, name, QUERIES[name], SQL[name])
    assert ok, said


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(spark.createDataFrame((out := stage(spark, frames[-1], SF_SMALL)).collect(), out.schema))
    assert all(f.columns == docs.columns for f in frames[:-1])
    rows = [[tuple(r) for r in f.collect()] for f in frames]
    quality = {r.doc_id: r for r in Q.judge(docs, ["doc_id"]).collect()}
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_measures(t) for d, t, *_ in rows[0] for r in [quality[d]])
    assert sorted(rows[1]) == sorted(r for r in rows[0] if not quality[r[0]].base_failed and quality[r[0]].quality >= 0.5)
    _, comps = brute_components([(r[0], r[1]) for r in rows[1]])
    assert sorted(rows[2]) == sorted(r for r, c in zip(rows[1], comps) if r[0] == c)
    bad = {r[0] for r in brute_decontam([(r[0], r[1]) for r in rows[2]], items) if r[5]}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] not in bad)
    want = Counter()
    for (d, t, s, *_), n in brute_mix([(r[0], r[1], r[3]) for r in rows[3]]).items():
        want[d, t, s] += n
    assert Counter((r[0], r[1], r[3]) for r in rows[4]) == want
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, expected = 0, []
    for r in sorted(rows[4]):
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 2]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows[5], key=lambda r: r[1]) == expected
