"""Packing: every id once, all limits kept, little padding, and the heuristic against a direct reading."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tradestar.llm import packing
from tradestar.llm.packing import Limits
from tradestar.llm.queries import op11_packing, packing_tokenizer_path

SCHEMA = "doc_id long, text string"


def padded(length: int, full: int) -> int:
    return length if length & (length - 1) == 0 else full


def check_layout(rows, full: int, segments: int = 64):
    """Sequences without gaps, within the limits; returns the share of padding."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    total = used = 0
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= full and len(pieces) <= segments
        total, used = total + padded(at, full), used + at
    return 1 - used / total if total else 0


def check_pieces(rows, ids_of):
    """``ids_of``: id -> list of id lists; every id lies in exactly one piece."""
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    want = defaultdict(list)
    for d, lists in ids_of.items():
        for ids in lists:
            want[d].append(len(ids))
    assert {d: sum(n for _, n, _, _ in p) for d, p in by.items()} == {d: sum(n) for d, n in want.items()}
    for d, pieces in by.items():
        if len(ids_of[d]) > 1:
            continue
        at, ids = 0, ids_of[d][0]
        for start, length, crc, n in sorted(pieces):
            assert start == at and n == len(ids)
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length


def sample():
    rnd = random.Random(8)
    words = ["Two", "Words", "it's", "ÉCOLE", "naïve", "42", "x1", "…", "漢字", "😀", "--", "é", "İstanbul"]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 60, 700]))) for _ in range(150)]
    return list(enumerate([*texts, None, "", " \n ", "a <|endoftext|> b", "word " * 30_000, "x" * 50_000])) + [(None, "nobody"), (3, "again"), (3, "again")]


def test_query_against_the_tokenizer(spark, tmp_dir):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as `a.b`", "2 as key", "3 as start", "4 as ids")
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    tokenizer = Tokenizer.from_file(packing_tokenizer_path())
    ids_of = defaultdict(list)
    for d, t in rows:
        ids_of[d].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    got = op11_packing(spark, tmp_dir).collect()
    check_pieces(got, ids_of)
    assert check_layout(got, 2048) < 0.005


def test_empty_table(spark, tmp_dir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    assert op11_packing(spark, tmp_dir).collect() == []


def test_many_tiny_texts_keep_the_segment_limit(spark):
    docs = spark.createDataFrame([(i, None if i % 3 else "a b c") for i in range(1000)], SCHEMA).coalesce(1)
    got = packing.pack_texts(docs, packing_tokenizer_path()).collect()
    assert sum(r.length for r in got) == 666 + 4 * 334
    check_layout(got, 2048)


def test_groups_are_bounded(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 900)) for i in range(400)], SCHEMA).coalesce(1)
    got = packing.pack_texts(docs, packing_tokenizer_path(), group_tokens=20_000).collect()
    assert sum(r.length for r in got) == sum(i % 900 + 1 for i in range(400))
    assert check_layout(got, 2048) < 0.005


def test_whole_examples_under_three_limits(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        n = rnd.choice([3, 20, 90, 300])
        prompt = rnd.randrange(n)
        rows.append((i, [rnd.randrange(50_000) for _ in range(n)], [False] * prompt + [True] * (n - prompt)))
    rows += [(1000, list(range(1500)), None), (1001, [], []), (1002, None, None), (1003, list(range(900)), [True] * 900), (1004, [1, 2, 3], [True])]
    limits = Limits(tokens=512, segments=8, loss=300)
    df = spark.createDataFrame(rows, "id long, ids array<int>, mask array<boolean>").coalesce(2)
    pieces = packing.pack_examples(df, loss_col="mask", limits=limits).collect()
    by, of = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append(p)
        of[p.id].append(p)
    for found in by.values():
        assert sum(p.length for p in found) <= 512 and len(found) <= 8 and sum(p.n_loss for p in found) <= 300
    for i, ids, mask in rows:
        mask = [True] * len(ids or []) if mask is None else mask
        found = sorted(of[i], key=lambda p: p.start)
        assert [x for p in found for x in np.frombuffer(p.ids, "<u4").tolist()] == list(ids or [])
        assert sum(p.n_loss for p in found) == sum(mask)
        if len(ids or []) <= 512 and sum(mask) <= 300:
            assert len(found) <= 1
    made = {r.sequence_id: r for r in packing.sequences(packing.pack_examples(df, loss_col="mask", limits=limits), limits).collect()}
    assert {k: (r.length, r.n_loss, len(r.segments)) for k, r in made.items()} == {k: (sum(p.length for p in v), sum(p.n_loss for p in v), len(v)) for k, v in by.items()}
    assert all(len(r.ids) == 4 * r.length and r.padded_length == padded(r.length, 512) for r in made.values())


def test_dot_product_choice_is_the_largest_of_all_that_fit():
    rnd = random.Random(1)
    limits = Limits(tokens=100, segments=6, loss=60)
    items = []
    for i in range(300):
        n = rnd.randint(1, 100)
        items.append((i, 0, n, rnd.randint(0, min(n, 60))))
    rest = {i: (n, loss) for i, _, n, loss in items}
    masks = [np.array([1] * loss + [0] * (n - loss)) for _, _, n, loss in items]
    for sequence in packing.pack_group(masks, items, limits, cut=False):
        room = [100, 6, 60]
        for item, _, n, loss in sequence:
            total = [sum(v[0] for v in rest.values()), len(rest), sum(v[1] for v in rest.values())]
            score = lambda v: sum(t / c * r * d / c**2 for t, c, r, d in zip(total, (100, 6, 60), room, (v[0], 1, v[1])))
            fit = [v for v in rest.values() if v[0] <= room[0] and v[1] <= room[2] and room[1]]
            assert score((n, loss)) >= max(map(score, fit)) - 1e-9
            del rest[item]
            room = [room[0] - n, room[1] - 1, room[2] - loss]
        assert not [v for v in rest.values() if v[0] <= room[0] and v[1] <= room[2] and room[1]]
    assert not rest
