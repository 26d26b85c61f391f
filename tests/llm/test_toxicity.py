from __future__ import annotations

import re
import zlib

from pyspark.sql import functions as F

from tradestar.llm import toxicity as X

PATTERN = re.compile(X.TOKEN)
LEXICON = X.Lexicon({"idiot": X.INSULT, "silly": X.MILD}, {"moro": X.INSULT})
ARCS = X.grammar()


def found(text):
    return dict(zip(X.FEATURES, X.count_clauses(text, LEXICON, ARCS, PATTERN)))


def brute(text):
    """The grammar read clause by clause, without transducers."""
    totals, quoted = dict.fromkeys(X.FEATURES, 0), False
    clause, clauses = [], []
    for token in [*PATTERN.findall(text.lower()), "."]:
        s = LEXICON[token]
        if s == X.END:
            clauses.append(clause)
            clause = []
        else:
            clause.append(s)
    for c in clauses:
        matches, target, verb, intent, left = [], False, False, False, 0
        for s in c:
            mark = ("-" if left else "") + ("r" if verb or quoted else "")
            left = X.NEGATION_SCOPE if s == X.NEGATION else max(0, left - 1)
            verb, quoted, intent, target = verb or s == X.REPORT, quoted ^ (s == X.QUOTE), intent or s == X.INTENT, target or s == X.TARGET
            if s in (X.INSULT, X.MILD) or s == X.HARM and intent:
                matches.append(s + mark)
        if matches:
            kinds = {m[0] for m in matches}
            totals["strong"] += X.INSULT in kinds
            totals["mild"] += X.MILD in kinds
            totals["threat"] += X.HARM in kinds
            totals["directed"] += target
            totals["negated"] += all("-" in m for m in matches)
            totals["reported"] += all("r" in m for m in matches)
    return totals


def test_grammar():
    assert found("You are an idiot.") == {"strong": 1, "mild": 0, "threat": 0, "directed": 1, "negated": 0, "reported": 0}
    assert found("not a moron") == {"strong": 1, "mild": 0, "threat": 0, "directed": 0, "negated": 1, "reported": 0}
    assert found("she said silly things")["reported"] == 1 and found('"idiot", wrote one')["reported"] == 1
    assert found("I will kill you")["threat"] == 1 and found("they kill time")["threat"] == 0
    assert found("not here. idiot")["negated"] == 0 and not any(found("a plain text, with you in it").values())


def test_composition_matches_direct_reading():
    import random

    rnd = random.Random(2)
    words = ["idiot", "silly", "morons", "kill", "will", "you", "not", "said", '"', ".", ",", "x", "and"]
    for _ in range(2000):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(25)))
        assert found(text) == brute(text), text


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = X.judge(docs, labels)
    n = {(r.toxic, r.predicted): r["count"] for r in got.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    recall, false = n.get((1, 1), 0) / (n.get((1, 1), 0) + n.get((1, 0), 0)), n.get((0, 1), 0) / (n.get((0, 1), 0) + n.get((0, 0), 0))
    print("held-out recall", recall, "false positives", false, n)
    assert recall > 0.85 and false < 0.01
    rows = got.select("doc_id", "held_out").collect()
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_held_out_labels_are_not_used(spark):
    import random

    rnd = random.Random(1)
    line = lambda i: " ".join([*(f"{rnd.choice('abcdefgh')}{rnd.choice('aeiou')}{rnd.choice('mnrst')}" for _ in range(12)), *["blorg"] * (i % 2)])
    docs = spark.createDataFrame([(i, line(i)) for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, X.judge(docs, x).collect())) for x in (labels, flipped))
    assert a == b and all((s >= 0.7) == bool(d % 2) == bool(p) for d, _, s, p in a)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "", 5), (None, "x", 5), (3, "word " * 100_000, 5)], "doc_id long, text string, score int")
    for labels in ([], [(1, 1), (1, 0), (None, 1), (2, None), (9, 1)]):
        got = X.judge(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == 0 and r.held_out is not None for r in got)
    assert X.judge(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
