from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest

from tradestar.llm import mixing as M


def md5(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def brute(rows, weights=None, seed=42, epochs=1.0):
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t or "")
    w = {s: math.pow(n, 0.5) if weights is None else weights.get(s, 0.0) for s, n in size.items()}
    total, all_w = sum(size.values()), sum(w.values())
    out = Counter()
    for d, t, s in rows:
        rate = w[s] / all_w * total * epochs / size[s] if size[s] and all_w else 1.0
        draws = max(1, math.ceil(rate / 64))
        name = str(d) if d is not None else "text " + hashlib.md5((t or "").encode()).hexdigest()
        n = 0
        for j in range(1, draws + 1):
            u = int(md5(str(seed), name, str(j))[:13], 16) / 2**52
            p = c = math.exp(-rate / draws)
            k = 0
            while c <= u and k < rate / draws + 12 * math.sqrt(rate / draws) + 30:
                k += 1
                p *= rate / draws / k
                c += p
                n += 1
        for k in range(1, n + 1):
            out[d, t, s, k, n, md5(f"{seed} order", name, str(k))] += 1
    return out


def rows():
    rnd = random.Random(6)
    out = [(i, "x" * rnd.randrange(1, 200), rnd.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(400)]
    return out + [(None, "lost", "b"), (None, None, "b"), (3, out[3][1], out[3][2]), (900, "", "void"), (901, None, "void")]


@pytest.mark.parametrize("weights,epochs", [(None, 1.0), ({"a": 1.0, "b": 300.0}, 2.0)])
def test_replicas_match_brute_force(spark, weights, epochs):
    df = spark.createDataFrame([(*r, "mine") for r in rows()], "doc_id long, text string, source string, copy string")
    got = M.replicate(df, weights, epochs=epochs)
    assert got.columns == ["doc_id", "text", "source", "copy", "n_copies", "mix_key"]
    assert Counter(map(tuple, got.collect())) == brute(rows(), weights, epochs=epochs)


def test_mix_meets_target_weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = M.replicate(docs, {"src0": 1.0, "src1": 1.0, "src2": 2.0}).groupBy("source").agg({"n_chars": "sum"}).collect()
    chars = {r[0]: r[1] for r in got}
    total = docs.agg({"n_chars": "sum"}).first()[0]
    assert set(chars) == {"src0", "src1", "src2"}
    assert abs(chars["src0"] / total - 0.25) < 0.02 and abs(chars["src2"] / total - 0.5) < 0.08


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.replicate(none).count() == 0
    assert {r.n_copies for r in M.replicate(spark.createDataFrame([(i, "", None) for i in range(50)], none.schema)).collect()} >= {1, 2}
