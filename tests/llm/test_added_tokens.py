"""Texts that hold an added token's string, against an unmodified tokenizer."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from test_token_store import texts
from tokenizers import Tokenizer

from tradestar.llm import token_store as S
from tradestar.llm.queries import token_records, tokenizer_path

ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext| >", "a <|endof text|> b", "é  <|endoftext|>\n\n 漢", "<|startoftext|> a<|endoftext|>"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_an_unmodified_tokenizer(name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    sample = [t or "" for t in [*ADDED, *texts(), *ADDED]]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in sample]
    S.PieceEncoder(path).encode(sample)  # the other way of a worker leaves this one as it is
    assert S.PieceEncoder(path, added_tokens=True).encode(sample) == want


def test_records_of_the_query(spark):
    plain = Tokenizer.from_file(tokenizer_path())
    rows = list(enumerate([*ADDED, "a b", None, *ADDED]))
    got = token_records(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).orderBy("start").collect()
    start, want = 0, []
    for d, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
