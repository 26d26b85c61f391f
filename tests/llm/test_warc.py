from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib

from tradestar.llm import warc as W

PAGE = '<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{x}</style><script>var t="</p>";</script></head><body><h1>A &amp; B</h1><p>one <b>two</b><br>three &eacute;</p><!-- no --><a href="/x?a=1&amp;b=2">link <i>here</i></a></body></html>'
sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()


def http(body: bytes, extra: bytes = b"Content-Type: text/html; charset=utf-8\r\n") -> bytes:
    block = b"HTTP/1.1 200 OK\r\n" + extra + b"\r\n" + body
    return W.make_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "http://h/p/"), ("WARC-Date", W.DATE), ("WARC-Payload-Digest", sha(body))], block)


def test_links_digests_and_text():
    meta, text = W.derive_record(http(PAGE.encode()))
    assert text["content"] == "A & B\none two\nthree é\nlink here".replace("é\nlink", "é\nlink")
    told = json.loads(meta["content"])
    assert told["title"] == "A & B" and told["lang"] == "fr" and told["links"] == [{"text": "link here", "url": "http://h/x?a=1&b=2"}]
    assert told["conversion"] == text["record_id"] and meta["record_id"] != text["record_id"]
    for r in (meta, text):
        headers, block = W.parse_record(r["record"])
        assert block == r["content"].encode() and headers["warc-block-digest"] == sha(block) == r["block_digest"]
        assert headers["warc-refers-to"] == r["refers_to"] == "<urn:uuid:1>" and headers["warc-target-uri"] == "http://h/p/"
        assert r["source_digest"] == sha(PAGE.encode()) and r["source_digest_ok"] and r["content_length"] == len(block)
        assert dict(r["source_headers"]) == {"content-type": "text/html; charset=utf-8"}


def test_encodings_types_and_faults():
    packed = gzip.compress(PAGE.encode())
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(packed[i : i + 50]), packed[i : i + 50]) for i in range(0, len(packed), 50)) + b"0\r\n\r\n"
    for body, extra in ((packed, b"Content-Encoding: gzip\r\n"), (zlib.compress(PAGE.encode()), b"Content-Encoding: deflate\r\n"), (chunks, b"Content-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n")):
        assert "three é" in W.derive_record(http(body, b"Content-Type: text/html\r\n" + extra))[1]["content"]
    assert "é" in W.derive_record(http("é".encode("latin-1"), b"Content-Type: text/plain; charset=latin-1\r\n"))[1]["content"]
    assert [r["warc_type"] for r in W.derive_record(http(b"\x89PNG", b"Content-Type: image/png\r\n"))] == ["metadata"]
    assert W.derive_record(W.make_record([("WARC-Type", "request")], b"GET /")) == []
    for bad in (None, b"", b"WARC/1.0\r\nContent-Length: 9\r\n\r\nshort", b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", http(b"x", b"Content-Encoding: gzip\r\n")):
        assert [bool(r.get("error")) for r in W.derive_record(bad)] == [True]
    assert not W.derive_record(http(b"x").replace(sha(b"x").encode(), sha(b"y").encode()))[0]["source_digest_ok"]


def test_files_round_trip(spark, tmp_dir):
    rows = [(i, f"http://h{i % 3}/p{i}", PAGE * (i % 4)) for i in range(40)] + [(40, None, None), (40, None, None), (None, "http://x/", "\r\n\r\n"), (41, "http://y/", "p" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("none", "x")
    made = W.responses(pages.repartition(4))
    W.write_warc(made, f"{tmp_dir}/warc")
    back = W.read_warc(spark, f"{tmp_dir}/warc")
    assert sorted(bytes(r.record) for r in back.collect()) == sorted(bytes(r.record) for r in made.collect())
    derived = W.derive(back, ["path", "offset"])
    W.write_warc(derived, f"{tmp_dir}/derived")
    again = [W.parse_record(bytes(r.record))[0] for r in W.read_warc(spark, f"{tmp_dir}/derived").collect()]
    assert len(again) == 2 * len(rows) and {h["warc-type"] for h in again} == {"metadata", "conversion"}
    known = {W.parse_record(bytes(r.record))[0]["warc-record-id"] for r in made.collect()}
    assert all(h["warc-refers-to"] in known for h in again)
    assert W.split_records(gzip.compress(b"".join(bytes(r.record) + b"\r\n\r\n" for r in made.collect())))[-1][1]
    assert W.derive(made.limit(0)).count() == 0
