"""Broken pages and files: linear time, good records found again; the query against an independent HTML reader."""

from __future__ import annotations

import gzip
import json
import time
import zlib
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from test_warc import http

from tests.conftest import SF_SMALL
from tradestar.llm import warc as W
from tradestar.llm.queries import op2_warc

BLOCKS = set("p div h1 h2 h3 h4 h5 h6 li ul ol tr table section article header footer nav main blockquote pre title body html br".split())


class Reader(HTMLParser):
    """The same page by the standard library's parser."""

    def __init__(self, base):
        super().__init__(convert_charrefs=True)
        self.base, self.hidden, self.head, self.text, self.links, self.link = base, 0, 0, [], [], None

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template")
        self.head += tag == "head"
        if tag in BLOCKS and not self.hidden and not self.head:
            self.text.append("\n")
        if tag == "a":
            self.handle_endtag("a")
            if dict(attrs).get("href") is not None:
                self.link = [urljoin(self.base, dict(attrs)["href"].strip()), []]
        elif self.link:
            self.link[1].append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript", "template")
        self.head -= tag == "head"
        if tag in BLOCKS and tag != "br" and not self.hidden and not self.head:
            self.text.append("\n")
        if tag == "a" and self.link:
            self.links.append({"url": self.link[0], "text": " ".join("".join(self.link[1]).split())})
            self.link = None
        elif self.link:
            self.link[1].append(" ")

    def handle_data(self, data):
        if not self.hidden:
            if self.link:
                self.link[1].append(data)
            if not self.head:
                self.text.append(data)


def test_query_over_all_pages_against_another_reader(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = op2_warc(spark, SF_SMALL).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page = pages[r.page_id]
        reader = Reader(page.url or "")
        reader.feed(page.html or "")
        reader.close()
        reader.handle_endtag("a")
        if r.warc_type == "conversion":
            lines = (" ".join(x.split()) for x in "".join(reader.text).split("\n"))
            assert r.content == "\n".join(x for x in lines if x)
        else:
            assert json.loads(r.content)["links"] == reader.links and r.n_links == len(reader.links)


@pytest.mark.parametrize("unit", ["<a href=x ", "<title>", "<head>", "<!--", "<script>", "<", "<a href='", "</head ", "<noscript ", "&", "<html lang "])
def test_a_megabyte_of_unclosed_markup(unit):
    begin = time.process_time()
    W.html_parts(unit * (1_000_000 // len(unit)), "http://h/")
    assert time.process_time() - begin < 3


def test_unclosed_elements():
    assert W.html_parts("a <b>c</b> < d")[0] == "a c < d"
    assert W.html_parts("a <!-- b > c")[0] == "a"
    assert W.html_parts("x <script>y")[0] == "x"
    assert W.html_parts("x < y <script z")[0] == "x < y"
    assert W.html_parts("<head>x<p>y")[0] == "x\ny"
    assert W.html_parts("<a href=u>v", "http://h/")[3] == [{"url": "http://h/u", "text": "v"}]
    assert W.html_parts("<a href=u>v<a>w</a>", "http://h/")[3] == [{"url": "http://h/u", "text": "v"}]
    assert W.html_parts("") == ("", "", "", [])


@pytest.mark.parametrize("stated", ["7", "70000", "-1", "x", ""])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_good_records_behind_a_broken_length(stated, pack):
    good = [http(b"<p>%d" % i) for i in range(4)]
    length = len(good[1].partition(b"\r\n\r\n")[2])
    broken = good[1].replace(b"Content-Length: %d" % length, b"Content-Length: " + stated.encode())
    data = b"\r\n\r\n".join([good[0], broken, good[2], good[3], b""])
    found = [W.derive_record(r) for _, r in W.split_records(pack(data))]
    assert [len(r) for r in found] == [2, 1, 2, 2] and found[1][0]["error"]
    assert [r[1]["content"] for r in found if len(r) == 2] == ["0", "2", "3"]


def test_broken_gzip_member_in_a_file():
    members = [gzip.compress(http(b"<p>%d" % i) + b"\r\n\r\n") for i in range(4)]
    members[1] = members[1][:20] + b"\x00\xff\x00\xff" + members[1][24:]
    found = [W.derive_record(r) for _, r in W.split_records(b"".join(members))]
    assert [r[1]["content"] for r in found if len(r) == 2] == ["0", "2", "3"]


def test_bodies_of_several_members_and_raw_deflate():
    two = gzip.compress(b"<p>first") + gzip.compress(b" second")
    assert W.derive_record(http(two, b"Content-Type: text/html\r\nContent-Encoding: gzip\r\n"))[1]["content"] == "first second"
    packer = zlib.compressobj(wbits=-15)
    raw = packer.compress(b"<p>raw") + packer.flush()
    assert W.derive_record(http(raw, b"Content-Type: text/html\r\nContent-Encoding: deflate\r\n"))[1]["content"] == "raw"
