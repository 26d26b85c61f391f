"""Signatures whose words are wrapped or spaced out, against all patterns without gate or keywords."""

from __future__ import annotations

import random
import re

import pytest
from test_licenses import PHRASES, WORD, texts

from tradestar.llm import licenses as L

SAID = [
    "All rights reserved", "is in the public domain", "dedicated to the public domain", "This program is free software: you can redistribute it and/or modify it", "released under CC0", "Distributed under the terms of the Boost Software",
    "Creative Commons", "subject to the terms of the Mozilla Public License", "General Public Licence", "Proprietary and", "Copyright (c) 2011", "Permission to use, copy, modify, and/or distribute this software for any purpose",
    "SPDX-License-Identifier: ISC", "Redistribution and use in source and binary forms, with or without modification, are permitted",
]


def brute_labels(text):
    """Every pattern over the whole text; a bare mention also needs the text to speak of a licence, which is its rule."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = []
    for i, r in enumerate(L.signatures()):
        if not r.base and (r.priority < 2 or r.label == "copyright" or "licen" in low):
            pattern = r.pattern.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff")
            found += [(m.start(), m.end(), r.priority, i, r.label) for m in re.finditer(pattern, low)]
    inside = lambda a: any(b[0] <= a[0] and b[1] >= a[1] and b != a and (b[2] < a[2] or b[2] == a[2] and (b[1] - b[0] > a[1] - a[0] or b[3] < a[3])) for b in found)
    words = WORD.findall(low)
    base = {label for p, label in PHRASES.items() if any(tuple(words[i : i + len(p)]) == p for i in range(len(words)))}
    return {a[4] for a in found if not inside(a)} | base


def said_by(words, rnd):
    """A text that the pattern ``words`` matches."""
    while found := re.search(r"\(\?:([^()]*)\)(\??)", words):
        words = words[: found.start()] + ("" if found[2] and rnd.random() < 0.5 else rnd.choice(found[1].split("|"))) + words[found.end() :]
    words = re.sub(r"(.)\?", lambda m: rnd.choice(["", m[1]]), words)
    return re.sub(r"\[(?:0-9|([a-z])[a-z])\]", lambda m: m[1] or "7", words)


def every_rule():
    rnd = random.Random(9)
    patterns = [w for *_, w in L.SPECIAL] + [form.format(name) for _, _, form in L.FORMS for *_, name in L.NAMES]
    return [re.sub(" ", lambda m: rnd.choice([" ", "\n", "  "]), said_by(p, rnd)) for p in patterns for _ in range(3)]


def wrapped():
    rnd = random.Random(8)
    out = [gap.join(said.split(" ")) for said in SAID for gap in (" ", "\n", "  ", " \n * ", "\t", "-")]
    loose = lambda said: "".join(rnd.choice([" ", "\n", "  ", "\r\n", "_"]) if c == " " else c for c in said)
    return out + [rnd.choice([". ", "\n", " word "]).join(loose(rnd.choice([*SAID, "ruby", "licen"])) for _ in range(rnd.randrange(1, 5))) for _ in range(200)]


@pytest.mark.parametrize("sample", [wrapped, every_rule, lambda: [t for t in texts() if len(t or "") < 10_000]], ids=["wrapped", "every_rule", "texts"])
def test_all_patterns_without_prefilter(spark, sample):
    rows = list(enumerate(sample()))
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ["doc_id"]).collect()}
    for d, t in rows:
        want = brute_labels(t)
        assert set(filter(None, got[d].labels.split(","))) == want, t
        assert (got[d].score > 0) == bool(want)


def test_wrapped_examples(spark):
    rows = [(0, "All\nrights reserved"), (1, "This is in the public  domain"), (2, "This program is free\nsoftware; you can redistribute it and/or modify it"), (3, "released\nunder CC0"), (4, "creative\n\ncommons"), (5, "Expat License")]
    got = [r.labels for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect()]
    assert got == ["proprietary", "public-domain", "gpl", "cc0-1.0", "creative-commons", "mit"]
