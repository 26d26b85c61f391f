from __future__ import annotations

import hashlib
import random
import re

import pytest

from tradestar.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    wins = []
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        wins += [(None if i is None else str(i), tuple(w[j : j + k])) for j in range(len(w) - k + 1) if k]
    by_len = {}
    for i, w in wins:
        by_len.setdefault(len(w), {}).setdefault(w, set()).add(i)
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for k, known in by_len.items():
            for j in range(len(w) - k + 1):
                if ids := known.get(tuple(w[j : j + k])):
                    hit.update(range(j, j + k))
                    found |= ids
        names = sorted(x for x in found if x is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def cases():
    rnd = random.Random(3)
    vocab = ["the", "of", "Éa", "x1", "and", "to", "in", "is", "zz", "ça"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([5, 13, 14, 30, 55]))) for i in range(30)]
    items += [(None, text(20)), (7, text(16)), (99, None), (98, ""), (97, " -- "), (3, items[3][1]), (120, "the the the the the the the the the the the the the the the"), (121, "solo")]
    docs = []
    for i in range(150):
        parts = [text(rnd.choice([0, 3, 40, 300]))]
        for _ in range(rnd.choice([0, 0, 1, 2])):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randrange(len(w) + 1)
            parts += [", ".join(w[a : a + rnd.choice([4, 13, 20, 60])]).upper(), text(rnd.choice([0, 50]))]
        docs.append((i, ". ".join(parts)))
    docs += [(5, docs[5][1]), (500, None), (501, ""), (None, items[4][1]), (502, "the " * 3000), (503, "Solo"), (504, "outside " * 10_000 + items[3][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes,shard", [(D.BLOCK_BYTES, D.SHARD_WORDS), (600, 500)])
def test_annotate_matches_brute_force(spark, monkeypatch, block_bytes, shard):
    monkeypatch.setattr(D, "SHARD_WORDS", shard)
    docs, items = cases()
    df = spark.createDataFrame([(d, t, "mine") for d, t in docs], "doc_id long, text string, n_words string")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = D.annotate(df, it, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "text", *D.RESULT]
    rows = sorted((tuple(r) for r in got.drop("text").collect()), key=str)
    assert rows == sorted(brute(docs, items), key=str)
    clean = D.remove_contaminated(df, it, block_bytes=block_bytes)
    assert clean.columns == df.columns
    assert sorted((str(r.doc_id) for r in clean.collect())) == sorted(str(r[0]) for r in brute(docs, items) if not r[5])


def test_longest_matches_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_WORDS", 700)
    docs, items = cases()
    items = [x for x in items if x[0] is not None and x[0] not in (7, 3)][:14]
    docs = docs[:60]
    want = set()
    tokens = [(d, words(t)) for d, t in docs]
    for i, t in items:
        w = words(t)
        for p in range(len(w)):
            best, at = 0, []
            for d, x in tokens:
                for q in range(len(x)):
                    k = 0
                    while p + k < len(w) and q + k < len(x) and w[p + k] == x[q + k]:
                        k += 1
                    if k > best:
                        best, at = k, []
                    if k == best:
                        at.append((d, q))
            if best >= 6:
                want |= {(str(i), p, best, d, q) for d, q in at}
    got = D.longest_matches(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), min_words=6)
    assert {tuple(r) for r in got.collect()} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in D.annotate(docs, none).collect()] == [False, False]
    assert D.annotate(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert D.remove_contaminated(docs, none).count() == 2


def test_equal_windows_of_many_items_are_searched_once(spark):
    items = [(i, "again " * (13 + i % 5)) for i in range(160)] + [(1000, "quite another thing to look for here and there and everywhere in the text")]
    rows = [(1, "again " * 20_000), (2, "nothing of it"), (3, "again " * 12), (4, "so quite another thing to look for here and there and everywhere in the text again")]
    got = D.annotate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, items))
    block = next(iter(D.item_blocks(spark.createDataFrame(items, "item_id long, text string"), 13, "item_id", "text")))[2]
    import numpy as np

    starts, owned, owners = D.distinct_windows(block, np.flatnonzero(block.span))
    assert len(starts) == 3 and sorted(np.diff(owned).tolist()) == [1, 1, 160]
