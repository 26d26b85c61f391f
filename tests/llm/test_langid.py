from __future__ import annotations

from collections import defaultdict
from math import exp, log

from tradestar.llm import langid as G

SF = "/root/testdata/sf0.1"


def test_accuracy(spark):
    pages, docs = spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    got = G.identify(pages, docs).collect()
    assert len(got) == pages.count()
    text = sum(r.text_lang == r.declared for r in got) / len(got)
    fused = sum(r.lang == r.declared for r in got) / len(got)
    print("text", text, "fused", fused)
    assert text > 0.97 and fused >= text
    # wrong or missing declarations and broken pages do not decide
    langs, table = G.train_text(docs)
    lies = spark.createDataFrame([(r.page_id, r.url, (r.html or "").replace(f'lang="{r.html[27:29]}"', "")) for r in pages.limit(300).collect()], "page_id long, url string, html string")
    assert all(r.declared is None for r in G.identify(lies, docs).collect())


def test_fusion_matches_brute_force(spark):
    import random

    rnd = random.Random(4)
    langs, k = ["de", "en", "fr"], G.SMOOTHING
    rows = []
    for i in range(200):
        logs = [-rnd.random() * rnd.choice([0, 1, 20]) for _ in langs]
        top = max(logs)
        rows.append((i, rnd.choice([None, "a.x.com", "a.x.com", "b.x.com", "y.org", "z"]), rnd.choice([None, "en", "en", "fr", "xx"]), [x - top for x in logs]))
    rows += [rows[0], (None, "a.x.com", "en", [0.0, 0.0, 0.0])]
    soft = lambda v: [exp(x - max(v)) / sum(exp(y - max(v)) for y in v) for x in v]
    ps = [soft(r[3]) for r in rows]
    n = len(langs)
    whole = [(sum(p[i] for p in ps) + 1 / n) / (len(ps) + 1) for i in range(n)]

    def add(key):
        out = defaultdict(lambda: [0.0] * n)
        for r, p in zip(rows, ps):
            if (x := key(r)) is not None:
                out[x] = [a + b for a, b in zip(out[x], p)]
        return out

    domain = lambda r: None if r[1] is None else ".".join(r[1].split(".")[-2:]) if "." in r[1] else ""
    suffix = lambda r: None if r[1] is None else r[1].split(".")[-1]
    host_c, domain_c, suffix_c, told_c = add(lambda r: r[1]), add(domain), add(suffix), add(lambda r: r[2])
    want = []
    for r, p in zip(rows, ps):
        total = list(r[3])
        for i in range(n):
            ratio = lambda c: log((c[i] + k * whole[i]) / (sum(c) + k) / whole[i])
            if r[1] is not None:
                c, d = host_c[r[1]], domain_c[domain(r)]
                parent = (d[i] + k * whole[i]) / (sum(d) + k)
                total[i] += log((max(c[i] - p[i], 0) + k * parent) / (max(sum(c) - 1, 0) + k)) + ratio(suffix_c[suffix(r)])
            else:
                total[i] += log(whole[i])
            if r[2] is not None:
                total[i] += ratio(told_c[r[2]])
        q = soft(total)
        want.append((str(r[0]), langs[q.index(max(q))], round(max(q), 9)))
    got = G.fuse(spark.createDataFrame(rows, "page_id long, host string, declared string, text array<double>"), langs).collect()
    assert sorted((str(r.page_id), r.lang, round(r.probability, 9)) for r in got) == sorted(want)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "the and of", "en"), (2, "der die das", "de"), (3, None, "fr"), (None, "x", "en"), (4, "y", None)], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (2, "", ""), (3, "no scheme", "<html lang=''>"), (4, "http://h.de/", "<html lang=DE-at><p>" + "die " * 50_000)], "page_id long, url string, html string")
    got = {r.page_id: r for r in G.identify(pages, docs).collect()}
    assert len(got) == 4 and got[4].lang == "de" and got[4].declared == "de" and got[1].declared is None
    assert G.identify(pages.limit(0), docs).count() == 0
    assert G.identify(pages, docs.limit(0)).count() == 0
