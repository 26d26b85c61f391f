from __future__ import annotations

import random
import re
from collections import Counter

from tradestar.llm import weak_quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def texts():
    rnd = random.Random(2)
    out = [None, "", " \t\n\x0b\x0c\r", "a", "one two three four five", "a b c d e a b c d e", "a " * 9, "x\r\nx\nx\n\n\n y\n", "é ü 😀 #*$%&|<> ÀÉ", "\x1c\x85 a b", "a b c d e f g h i j " * 2]
    for _ in range(150):
        words = [rnd.choice(["aa", "b", "Ç", "d#", "e|", "F"]) + str(rnd.randrange(3)) for _ in range(rnd.choice([4, 5, 6, 30, 300]))]
        out.append("".join(w + rnd.choice([" ", " ", "\n", "  ", "\t"]) for w in words))
    out.append("long words repeat here now " * 30_000)
    return out


def test_measures_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(1, ""), (None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Q.judge(df, ["doc_id"]).select("doc_id", *Q.MEASURES[:5], "base_failed")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((d, *brute(t)) for d, t in rows), key=str)


def test_em_finds_accuracies():
    rnd = random.Random(8)
    right = {"a": 0.95, "b": 0.85, "c": 0.7, "d": 0.6, "e": 0.9}
    seen, truth = Counter(), Counter()
    for _ in range(20_000):
        y = 1 if rnd.random() < 0.7 else -1
        votes = tuple(0 if rnd.random() < 0.3 else y if rnd.random() < p else -y for p in right.values())
        seen[votes] += 1
    model = Q.fit_votes([(dict(zip(right, v)), n) for v, n in sorted(seen.items())], dict.fromkeys(right, 0.7), 0.7, trust=0)
    for r, p in right.items():
        assert abs(model.accuracy[r] - p) < 0.05, r


def test_held_out_labels_and_removal(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality is not null").selectExpr("doc_id", "quality AS label")
    got = Q.judge(docs, ["doc_id"]).join(labels, "doc_id").groupBy("label", "kept").count().collect()
    n = {(r.label, r.kept): r["count"] for r in got}
    good, bad = n.get((1, True), 0) / (n.get((1, True), 0) + n.get((1, False), 0)), n.get((0, False), 0) / (n.get((0, True), 0) + n.get((0, False), 0))
    print("kept of good", good, "rejected of bad", bad, n)
    assert good > 0.95 and bad > 0.95


def test_removal_keeps_columns_and_clashing_names(spark):
    rows = [(1, "plain words stand here, one after the other, until the text has quite enough of them to pass every rule there is", 5, {"a": 1}), (2, "no", 7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept map<string,int>")
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == rows[:1]
    judged = Q.judge(df)
    assert judged.columns.count("n_words") == 1 and judged.filter("n_words = 1").count() == 1
    assert Q.judge(df.limit(0)).count() == 0 and Q.keep_good(df.limit(0)).count() == 0


def test_posterior_replaces_passing_every_rule(spark):
    prose = "the river runs past the old mill and then turns towards the sea where boats wait for wind and rain all through autumn".split()

    def text(i, n):
        rnd = random.Random(i)
        return " ".join(rnd.choice(prose) + str(rnd.randrange(100)) for _ in range(n))

    page = "\n".join(x for i in range(12) for x in ([text(900 + i, 12), "next page"] if i < 8 else [text(900 + i, 12)]))
    rows = [(i, text(i, 150)) for i in range(60)]
    rows += [(100 + i, " ".join(w + " ##" for w in text(i, 120).split())) for i in range(6)]  # symbols
    rows += [(200 + i, "again and again the same few words " * 20) for i in range(4)]  # copied words: base check
    rows += [(300, text(300, 30)), (301, page), (302, text(302, 12))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    votes = [f"vote_{r.name}" for r in Q.RULES]
    got = {r.doc_id: r for r in Q.judge(df, ["doc_id"]).collect()}
    bad = {d for d, r in got.items() if any(r[v] < 0 for v in votes)}
    assert got[300].vote_length == got[301].vote_lines == got[302].vote_length == -1 and {300, 301, 302} <= bad
    assert {d for d, r in got.items() if r.kept} == {*range(60), 300, 301, 302}
    assert all(got[d].quality > 0.9 for d in (300, 301, 302))
    assert all(r.quality < 0.2 and not r.base_failed for d, r in got.items() if 100 <= d < 200)


def test_query_verdicts_differ_from_all_must_pass(spark):
    got = Q.judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), ["doc_id"]).filter("not base_failed")
    worst = " or ".join(f"vote_{r.name} < 0" for r in Q.RULES)
    gross = " or ".join(f"vote_{r.name} < 0" for r in Q.RULES if r.sure == Q.GROSS)
    n = got.selectExpr(f"count_if(kept and ({worst})) AS saved", f"count_if(kept and ({gross})) AS let_through", "count_if(not kept) AS lost").first()
    print(n)
    assert n.saved > 100 and n.let_through == 0 and n.lost > 100


def test_model_without_documents():
    belief = {"a": 0.9, "b": 0.6}
    model = Q.fit_votes([], belief, 0.8, finds=0.3)
    assert model.balance == 0.8 and model.passes == belief and set(model.finds.values()) == {0.3}
    never = Q.fit_votes([({"a": 1, "b": 0}, 10)], belief, 0.8, finds=0.3)
    assert never.passes["b"] == 0.6 and never.finds["b"] == 0.3
