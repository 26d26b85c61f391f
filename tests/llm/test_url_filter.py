from __future__ import annotations

import re

from tradestar.llm import url_filter as U


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for says, rule in U.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (says, rule)
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "http://ORG/x", "http://a.org", "http://a.org?x", "http://A.Example.ORG/es/5", "https://example.org/en/1", "https://example.org/en/19?z", "https://example.org/en/2#f",
    "http://xexample.org/es/1", "http://a.com/fr/1", "http://a.com/fr", "http://a.com/de/7", "http://com/de/", "http://a.net/de/1", "http://É.org/ü", "a://b://c.org/d", "http://u@h.org:80/es/", "http://x.com/" + "p" * 5000, "http://org.evil.net/x", "http://a.com//de/",
]


def test_rules_match_brute_force(spark):
    rows = [(i, u, "mine") for i, u in enumerate(URLS)] + [(None, URLS[4], None), (4, URLS[4], None)]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, u in enumerate(URLS):
        host, path, best = brute(u)
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, best and best[1]), u
        assert by[i].verdict == best[0] if best else by[i].verdict in ("allow", "block")


def test_held_out_accuracy(spark):
    """Trained on a third of the labelled URLs, right on the rest without the rules."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    known = [(r.page_id, r.url, brute(r.url)[2][0]) for r in pages.collect() if brute(r.url)[2]]
    train = spark.createDataFrame([(u, v) for d, u, v in known if d % 3 == 0], "url string, verdict string")
    rest = spark.createDataFrame([(d, u, v) for d, u, v in known if d % 3], "page_id long, url string, truth string")
    got = U.judge(rest, train, rules=()).collect()
    right = sum(r.verdict == r.truth for r in got) / len(got)
    print("held-out accuracy", right)
    assert right > 0.9


def test_one_kind_or_no_label_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    label = lambda *rows: spark.createDataFrame(list(rows), "url string, verdict string")
    assert U.judge(pages, label()).first().verdict == "allow"
    assert U.judge(pages, label(("http://b.net/", "block"))).first().verdict == "block"
    assert U.judge(pages.limit(0)).count() == 0
