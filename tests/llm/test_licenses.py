from __future__ import annotations

import random
import re

from tradestar.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def brute(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for i in range(len(w)) for p, label in PHRASES.items() if tuple(w[i : i + len(p)]) == p]
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))


def brute_labels(text):
    """Plain double loop over the same signatures with Python's regex."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    if not re.search(L.GATE, text or ""):
        return set()
    found = []
    for i, r in enumerate(L.signatures()):
        if all(k in low for k in r.keywords):
            pattern = r.pattern.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff")
            found += [(m.start(), m.end(), r.priority, i, r.label) for m in re.finditer(pattern, low) if not r.base]
    kept = set()
    for a in found:
        if not any(b[0] <= a[0] and b[1] >= a[1] and b != a and (b[2] < a[2] or b[2] == a[2] and (b[1] - b[0] > a[1] - a[0] or b[3] < a[3])) for b in found):
            kept.add(a[4])
    return kept | set(filter(None, brute(text)[4].split(",")))


def texts():
    rnd = random.Random(3)
    bits = ["MIT License", "apache\nlicense", "general public license", "GNU General Public License, version 3", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: BSD-3-Clause", "This work is licensed under the GNU General Public License, version 3", "all rights reserved", "mitélicense", "xmit license", "mit licenses", "public domain", "Copyright (c) 2011", "éé", "word", "mit", "license", "İ", "ſ"]
    out = [None, "", " ", "MIT LICENSE", "mit--license", "Mit license mit license", "mit mit license", "the mit\n\n(license)"]
    out += [rnd.choice([" ", ", ", "\n", ""]).join(rnd.choice(bits) for _ in range(rnd.randrange(1, 14))) for _ in range(200)]
    return out + ["filler words " * 20_000 + "under the MIT License here", "mit license. " * 1500]


def test_scan_matches_brute_force(spark):
    rows = [(i, t, "mine") for i, t in enumerate(texts())] + [(3, "MIT LICENSE", "x"), (None, "apache license", None)]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string"), ["doc_id"]).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(((d, *brute(t)) for d, t, _ in rows), key=str)
    of = {r.doc_id: r for r in got}
    for d, t, _ in rows:
        if d is not None:
            assert set(filter(None, of[d].labels.split(","))) == brute_labels(t), t
            assert 0 <= of[d].score <= 1 and (of[d].score > 0) == bool(of[d].labels)
            assert all(0 <= x.start < x.end <= len(t or "") for x in of[d].detections)


def test_suppression_and_names(spark):
    rows = ["Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3", "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-2.0-only", "plain prose"]
    got = [r.labels for r in L.scan(spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect()]
    assert got == ["cc-by-nc-4.0", "mit", "gpl,gpl-3.0", "apache,apache-2.0", "gpl-2.0", ""]
    assert len(L.signatures()) > 300


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, score int")
    assert L.scan(df).count() == 0 and L.scan(df).columns == ["doc_id", "text", *L.RESULT, "detections"]
