from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradestar.llm import mph
from tradestar.llm import token_store as S

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def texts():
    odd = ["a  b", " a", "a ", "x \n y", "a\t b", "　 a", "don't  'll x's", " ", "", None, "<|endoftext|> a", "a\r\n b", "é  \n\n ü x", "a \x1c b", "a\x85 b", "# # id two #", "word " * 20_000]
    rnd = random.Random(4)
    return odd + ["".join(rnd.choice([" ", "  ", "\n", "é", "ab", "9", "'s", "!", " ", "漢", "😀"]) for _ in range(rnd.randrange(60))) for _ in range(300)]


def test_pieces_give_the_tokenizers_ids(tokenizer):
    got = S.PieceEncoder(PATH).encode([t or "" for t in texts()])
    assert got == [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in texts()]


def test_other_vocabularies_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    sample = ["Two Words", "", "a  b\nc", "é 漢"]
    assert S.PieceEncoder(path).encode(sample) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u2").tobytes() for x in sample]


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
        levels = mph.build(keys)
        assert sorted(mph.slots(levels, keys).tolist()) == list(range(len(keys)))


@pytest.mark.parametrize("shard,segment", [(S.SHARD_BYTES, S.SEGMENT_BYTES), (3000, 500)])
def test_round_trip_and_keyed_access(spark, tmp_dir, tokenizer, shard, segment):
    rows = [(3 * i - 20, t) for i, t in enumerate(texts())] + [(1, "again"), (1, "again"), (1, "else"), (None, "no key"), (None, None), (2**40, "far")]
    random.Random(1).shuffle(rows)
    path = f"{tmp_dir}/store"
    S.write_store(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, PATH, shard_bytes=shard, segment_bytes=segment)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in S.scan(spark, path).collect()), key=lambda r: r[0])
    ids = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    assert [r[1] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert got[0][0] == 0 and all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:]))
    crc = lambda t: zlib.crc32(np.array(ids(t), "<u4").tobytes())
    assert sorted(((d, n, c) for _, d, n, c in got), key=str) == sorted(((d, len(ids(t)), crc(t)) for d, t in rows), key=str)
    asked = [1, 2**40, -20, 999_999, 5, -(2**50)]
    found = S.lookup(spark, path, asked).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in found) == sorted((d, ids(t)) for d, t in rows if d in asked)
    starts = {r[0]: r[1:] for r in got}
    assert all(starts[r.start] == (r.doc_id, r.n_tokens, r.ids_crc32) for r in found)
    assert S.lookup(spark, path, [2**50]).count() == 0


def test_empty_table(spark, tmp_dir):
    S.write_store(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_dir}/store", PATH)
    assert S.scan(spark, f"{tmp_dir}/store").count() == 0


@pytest.mark.parametrize("rows,words", [(3000, 2000), (300_000, 0)])
def test_files_are_small_enough_to_be_read_back_whole(spark, tmp_dir, rows, words):
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), words).alias("text"))
    found = S.write_store(docs, f"{tmp_dir}/store", PATH)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{tmp_dir}/store/ids")
    assert files.agg(F.max("length")).first()[0] < 8_000_000
    assert found.count() == rows
