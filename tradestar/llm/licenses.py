"""License scan: ordered signature rules behind a keyword prefilter.

A text without any of the gate's keywords is done after one scan.  Of the others,
only the rules whose own keyword occurs run their regular expression; each match is
a detection with its interval.  A detection that lies inside one of a rule of equal
or higher priority is suppressed, in one sweep over the ordered intervals.
All of it happens inside a row, in built-in functions; there is no shuffle.

Three base phrases are rules of their own that nothing suppresses.

Defined cases: a null text is empty; without a detection the labels are empty
strings, the word places null and the score 0; repeated rows get a row each; an
empty table gives an empty result; result columns replace input columns of their names.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.common import ascii_lower, let, without

#: Fixed values of the contract: words of a base phrase, and its label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Word characters of a lower-cased text, and what stands between words (Java).
IN_WORD = r"0-9a-z\x{80}-\x{10FFFF}"
GAP = f"[^{IN_WORD}]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: License label, keyword, and its name as a pattern over lower-cased words (a blank is any gap, a dot in a version any character).
NAMES = (
    ("mit", "mit", "mit"),
    ("mit", "expat", "expat"),
    ("mit-0", "mit", "mit (?:no attribution|0)"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1.1"),
    ("apache-2.0", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?2(?:.0)?"),
    ("gpl-1.0", "g", "(?:gnu )?(?:gpl|general public license)(?: version| v)? ?1(?:.0)?"),
    ("gpl-2.0", "g", "(?:gnu )?(?:gpl|general public license)(?: version| v)? ?2(?:.0)?"),
    ("gpl-3.0", "g", "(?:gnu )?(?:gpl|general public license)(?: version| v)? ?3(?:.0)?"),
    ("lgpl-2.1", "l", "(?:gnu )?(?:lgpl|(?:lesser|library) general public license)(?: version| v)? ?2(?:.1)?"),
    ("lgpl-3.0", "l", "(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?3(?:.0)?"),
    ("agpl-3.0", "a", "(?:gnu )?(?:agpl|affero general public license)(?: version| v)? ?3(?:.0)?"),
    ("gfdl", "documentation", "(?:gnu )?free documentation license"),
    ("bsd-0-clause", "bsd", "(?:0|zero) clause bsd"),
    ("bsd-1-clause", "bsd", "(?:1|one) clause bsd"),
    ("bsd-2-clause", "bsd", "(?:2 clause|two clause|simplified) bsd"),
    ("bsd-3-clause", "bsd", "(?:3 clause|three clause|new|modified|revised) bsd"),
    ("bsd-4-clause", "bsd", "(?:4 clause|four clause|original) bsd"),
    ("isc", "isc", "isc"),
    ("mpl-1.1", "m", "(?:mozilla public license|mpl)(?: version| v)? ?1.1"),
    ("mpl-2.0", "m", "(?:mozilla public license|mpl)(?: version| v)? ?2(?:.0)?"),
    ("epl-1.0", "e", "(?:eclipse public license|epl)(?: version| v)? ?1(?:.0)?"),
    ("epl-2.0", "e", "(?:eclipse public license|epl)(?: version| v)? ?2(?:.0)?"),
    ("eupl-1.2", "e", "(?:european union public licen[cs]e|eupl)(?: version| v)? ?1.2"),
    ("cddl-1.0", "c", "(?:common development and distribution license|cddl)"),
    ("cpl-1.0", "common", "common public license"),
    ("artistic-1.0", "artistic", "artistic(?: license)?(?: version| v)? ?1(?:.0)?"),
    ("artistic-2.0", "artistic", "artistic(?: license)?(?: version| v)? ?2(?:.0)?"),
    ("boost-1.0", "boost", "boost(?: software)?"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("cc0-1.0", "c", "(?:cc0|creative commons zero)(?: 1.0)?"),
    ("cc-by-3.0", "c", "(?:cc by|creative commons attribution) 3.0"),
    ("cc-by-4.0", "c", "(?:cc by|creative commons attribution) 4.0"),
    ("cc-by-sa-3.0", "c", "(?:cc by sa|creative commons attribution share ?alike) 3.0"),
    ("cc-by-sa-4.0", "c", "(?:cc by sa|creative commons attribution share ?alike) 4.0"),
    ("cc-by-nc-4.0", "c", "(?:cc by nc|creative commons attribution non ?commercial) 4.0"),
    ("cc-by-nd-4.0", "c", "(?:cc by nd|creative commons attribution no ?derivatives) 4.0"),
    ("cc-by-nc-sa-4.0", "c", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4.0"),
    ("cc-by-nc-nd-4.0", "c", "(?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives) 4.0"),
    ("odbl-1.0", "o", "(?:odbl|open database license)"),
    ("ofl-1.1", "o", "(?:ofl|open font license)"),
    ("python-2.0", "python", "python(?: software foundation)?"),
    ("php-3.01", "php", "php"),
    ("postgresql", "postgresql", "postgresql"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"),
    ("ms-pl", "m", "(?:ms pl|microsoft public license)"),
    ("upl-1.0", "u", "(?:upl|universal permissive license)"),
)

#: How a license is named, by priority: 0 a grant or an identifier, 1 the name as a license, 2 a mention
#: (of a text with "licen" anywhere); and how sure that is.
FORMS = (
    (0, "licen", "(?:is |are )?licen[cs]ed (?:under|according to)(?: the)?(?: terms of(?: the)?)? {}(?: licen[cs]e)?"),
    (0, "release", "released under(?: the)?(?: terms of(?: the)?)? {}(?: licen[cs]e)?"),
    (0, "distribute", "distributed under(?: the)?(?: terms of(?: the)?)? {}(?: licen[cs]e)?"),
    (0, "spdx", "spdx license identifier {}(?: only| or later)?"),
    (1, "licen", "{} licen[cs]e"),
    (1, "licen", "licen[cs]e {}"),
    (2, "licen", "{}"),
)
SURE = (0.95, 0.8, 0.4)

#: Signatures that are not made of a name: priority, label, keyword (one word of every match), pattern.
SPECIAL = (
    (0, "gpl-3.0", "licensed", "licensed under the gnu general public license version 3"),
    (0, "gpl-2.0", "licensed", "licensed under the gnu general public license version 2"),
    (0, "apache-2.0", "licensed", "licensed under the apache license version 2 0"),
    (0, "mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    (0, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    (0, "isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    (0, "gpl", "redistribute", "this (?:program|library|file) is free software you can redistribute it and or modify it"),
    (0, "mpl", "mozilla", "subject to the terms of the mozilla public license"),
    (0, "public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    (1, "public-domain", "domain", "(?:is|are) (?:in|part of) the public domain"),
    (1, "proprietary", "rights", "all rights reserved"),
    (1, "proprietary", "proprietary", "proprietary (?:and|licen[cs]e|software)"),
    (1, "apache", "apache", "apache (?:software )?licen[cs]e"),
    (1, "gpl", "general", "(?:gnu )?general public licen[cs]e"),
    (1, "bsd", "bsd", "bsd licen[cs]e"),
    (1, "creative-commons", "commons", "creative commons"),
    (2, "copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
)

#: Every text with a detection has one of these, whatever stands between the words.
GATE = rf"(?i)licen|copyright|spdx|public{BETWEEN}domain|all{BETWEEN}rights|redistribut|permission|proprietary|creative{BETWEEN}commons|(?:released|distributed){BETWEEN}under"

RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@dataclass(frozen=True)
class Signature:
    priority: int
    label: str
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False


def _pattern(words: str) -> str:
    """Words with any gap at each blank, at word boundaries; optional groups carry their own blank."""
    loose = words.replace(" ?", "\0").replace(".", GAP).replace(" ", GAP).replace("\0", f"(?:{GAP})?")
    return f"(?<![{IN_WORD}])(?:{loose})(?![{IN_WORD}])"


def signatures() -> list[Signature]:
    """All rules in order: the base phrases, the special ones, then every form of every name."""
    out = [Signature(0, label, (phrase.split()[0], "license"), _pattern(phrase), True) for phrase, label in BASE]
    out += [Signature(p, label, (keyword,), _pattern(words)) for p, label, keyword, words in SPECIAL]
    return out + [Signature(p, label, (keyword, word), _pattern(form.format(name))) for p, keyword, form in FORMS for label, word, name in NAMES]


def _detections(low: Column, rules: list[Signature]) -> Column:
    """All matches as an array of (start, end, priority, rule, label, base), by start, longest first; characters from 0."""
    rows = [{"rule": i, "keyword": r.keywords[0], "word": r.keywords[-1], "pattern": r.pattern, "priority": r.priority, "label": r.label, "base": r.base} for i, r in enumerate(rules)]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<rule:int,keyword:string,word:string,pattern:string,priority:int,label:string,base:boolean>>")
    empty = F.array().cast("array<struct<start:int,back:int,priority:int,rule:int,label:string,base:boolean>>")

    def matches(r: Column) -> Column:
        def placed(found: Column) -> Column:
            def step(state: Column, i: Column) -> Column:
                start = state["at"] + F.length(F.get(found["rest"], i))
                end = start + F.length(F.get(found["hits"], i))
                hit = F.struct(start.alias("start"), (-end).alias("back"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label"), r["base"].alias("base"))
                return F.struct(end.alias("at"), F.concat(state["all"], F.array(hit)).alias("all"))

            steps = F.when(F.size(found["hits"]) > 0, F.sequence(F.lit(0), F.size(found["hits"]) - 1)).otherwise(F.array().cast("array<int>"))
            return F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("all")), step, lambda s: s["all"])

        return let(F.struct(F.regexp_extract_all(low, r["pattern"], F.lit(0)).alias("hits"), F.split(low, r["pattern"], -1).alias("rest")), placed)

    likely = F.filter(table, lambda r: F.contains(low, r["keyword"]) & F.contains(low, r["word"]))
    return F.sort_array(F.flatten(F.transform(likely, matches)))


def _sweep(found: Column) -> Column:
    """Labels and score of the detections that no detection of equal or higher priority contains."""
    start = F.struct(F.array(*[F.lit(-1)] * len(SURE)).alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(1.0).alias("doubt"))

    def step(state: Column, d: Column) -> Column:
        end = -d["back"]
        inside = F.array_max(F.slice(state["reach"], F.lit(1), d["priority"] + 1)) >= end
        reach = F.transform(state["reach"], lambda m, i: F.when(i == d["priority"], F.greatest(m, end)).otherwise(m))
        sure = F.element_at(F.array(*[F.lit(x) for x in SURE]), d["priority"] + 1)
        return F.struct(
            reach.alias("reach"),
            F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(d["label"]))).alias("labels"),
            F.when(inside, state["doubt"]).otherwise(state["doubt"] * (1 - sure)).alias("doubt"),
        )

    return F.aggregate(found, start, step, lambda s: F.struct(s["labels"].alias("labels"), (1 - s["doubt"]).alias("score")))


def _n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, BETWEEN), "")).cast("long")


def scan(docs: DataFrame, keep: list[str] | None = None, rules: list[Signature] | None = None, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns (default: all) with word and phrase counts, base labels, labels, score, and ``detections`` (all, before suppression)."""
    rules = signatures() if rules is None else rules
    rest = without(docs, *RESULT, "detections")
    kept = rest.columns if keep is None else keep
    text = F.coalesce(docs[text_col], F.lit(""))

    def of(low: Column) -> Column:
        def judged(found: Column) -> Column:
            base = F.filter(found, lambda d: d["base"])

            def word(at: Column) -> Column:
                return _n_words(F.substring(low, F.lit(1), at["start"]))

            return let(
                base,
                lambda b: F.struct(
                    found.alias("detections"),
                    F.size(b).cast("long").alias("n_base"),
                    F.when(F.size(b) > 0, word(F.get(b, F.lit(0)))).alias("first_word"),
                    F.when(F.size(b) > 0, word(F.get(b, F.size(b) - 1))).alias("last_word"),
                    F.array_sort(F.array_distinct(F.transform(b, lambda d: d["label"]))).alias("base_labels"),
                    _sweep(F.filter(found, lambda d: ~d["base"])).alias("own"),
                ),
            )

        return let(_detections(low, rules), judged)

    low = F.when(text.rlike(GATE), ascii_lower(text)).otherwise("")
    found = docs.select(*kept, F.struct(_n_words(text).alias("n_words"), let(low, of).alias("found")).alias("_scanned"))
    s, own = F.col("_scanned.found"), F.col("_scanned.found.own")
    # doubt left by the base detections, which count as names of a license
    base_doubt = F.pow(F.lit(1 - SURE[1]), F.size(s["base_labels"]).cast("double"))
    return found.select(
        *kept,
        F.col("_scanned.n_words").alias("n_words"),
        s["n_base"].alias("n_base"),
        s["first_word"].alias("first_word"),
        s["last_word"].alias("last_word"),
        F.array_join(s["base_labels"], ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(s["base_labels"], own["labels"])), ",").alias("labels"),
        (1 - (1 - own["score"]) * base_doubt).alias("score"),
        F.transform(s["detections"], lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["priority"].alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"), d["base"].alias("base"))).alias("detections"),
    )
