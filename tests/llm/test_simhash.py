from __future__ import annotations

import random

import pytest
import xxhash

from tradestar.llm import simhash as S


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=2):
    """{row number: smallest id reachable}"""
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return fps, [low.get(root(i)) for i in range(len(rows))]


def corpus():
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(rnd.choice([2, 9, 60, 400]))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(80):
        words = rnd.choice(base).split()
        if len(words) > 20:
            words[rnd.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (5, base[5]), (None, base[7]), (None, "only here, without id"), (None, "only here, without id"), (7, "UPPER case Words é É"), (2003, "x " * 50_000)]
    rows += [(3000 + i, base[3]) for i in range(300)]
    return rows


def test_components_match_brute_force(spark):
    rows = corpus()
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps, comps = brute_components(rows)
    want = sorted(((d, f - (1 << 64) if f >> 63 else f, c) for (d, _), f, c in zip(rows, fps, comps)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_chains_and_hot_group(spark):
    # a chain of one-bit steps, a ball of neighbours, and lone values; small tiles force splits
    rnd = random.Random(1)
    chain, x = [], rnd.getrandbits(64)
    for b in range(64):
        x ^= 1 << b
        chain.append(x)
    centre = rnd.getrandbits(64)
    ball = [centre ^ 1 << a ^ 1 << b for a in range(24) for b in range(a, 24)]
    fps = sorted({*chain, *ball, *(rnd.getrandbits(64) for _ in range(500))})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, tile_rows=5)
    assert edges.count() < 40 * len(fps)
    got = {r.node: r.root for r in S.components(edges).collect()}
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    groups, mine = {}, {}
    for f, s in zip(fps, signed):
        groups.setdefault(root(f), set()).add(s)
        mine.setdefault(got.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_deduplicate_keeps_one_of_each_group(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, {"k": str(i)}, 1) for i, (d, t) in enumerate(rows)], "doc_id long, text string, extra map<string,string>, fp int")
    kept = S.deduplicate(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    # every row takes the place of its own number, so that a repeated id names no group
    fps, groups = brute_components([(i, t) for i, (_, t) in enumerate(rows)])
    lowest = {}
    for g, (d, t) in zip(groups, rows):
        lowest[g] = min(lowest.get(g, (True, 0)), (d is None, d or 0))
    assert sorted((d is None, d or 0) for d, _ in got) == sorted(lowest.values())
    assert set(got) <= set(rows) and len({t for d, t in got if d == 7}) == 2
    assert [t for d, t in got if d is None] == ["only here, without id"]


def test_texts_of_a_repeated_id_stay_unless_they_are_copies(spark):
    a, b, c = ("the first of three texts is about rain and rivers in the north", "a second one counts ships and bricks and lists of names", "nobody knows why this other text has no number at all")
    rows = [(5, a, 1), (5, a, 0), (5, b, 2), (7, b, 3), (None, c, 4), (None, c, 5), (None, a, 6), (8, None, 7), (8, "", 8), (9, " ", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    got = [tuple(r) for r in S.deduplicate(df).collect()]
    assert {r for r in got if r[0] != 8} == {(5, a, 0), (5, b, 2), (None, c, 4)}
    assert [r[0] for r in got].count(8) == 1 and len(got) == 4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None)]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert S.near_duplicates(df).count() == len(rows)
    assert S.deduplicate(df).count() == len(rows)
