"""WARC derivatives: linked metadata and plain-text conversion records from response records.

A record is one row with its raw bytes.  Each response gives a metadata record
(title, language, links and HTTP headers as JSON) and, if it is text, a conversion
record (its plain text).  Both refer to the response by its identifier, keep its
target and date, and carry its payload digest; the metadata names the conversion.
Writing goes through Spark's text writer, whose line separator is the end of a
record; reading goes through Spark's binary reader and the stated content lengths.

Defined cases: records of other types give nothing; a null or broken record gives
one row with ``error`` and nothing else; a body that is not text gives metadata only;
equal records give equal identifiers; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.common import bytes_of

VERSION = b"WARC/1.0"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
CONVERTED = ("text/", "application/xhtml", "application/xml", "application/json")

DERIVED = T.StructType(
    [
        T.StructField("warc_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("warc_date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("source_digest", T.StringType()),
        T.StructField("source_digest_ok", T.BooleanType()),
        T.StructField("block_digest", T.StringType()),
        T.StructField("source_headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("n_links", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("record", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


def digest(data: bytes) -> str:
    from base64 import b32encode
    from hashlib import sha1

    return "sha1:" + b32encode(sha1(data).digest()).decode()


def identifier(*parts: bytes) -> str:
    from hashlib import md5
    from uuid import UUID

    return f"<urn:uuid:{UUID(bytes=md5(b'|'.join(parts)).digest())}>"


def make_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + lines + b"\r\n" + block


def parse_headers(lines: bytes) -> dict[str, str]:
    """Header fields by lower-cased name; a folded line continues the one before, of repeated fields the first holds."""
    found, last = {}, None
    for line in lines.split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in " \t" and last:
            found[last] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            last = name.strip().lower()
            if last in found:
                last = None
            else:
                found[last] = value.strip()
    return found


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, mark, rest = raw.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/"):
        raise ValueError("no WARC header")
    headers = parse_headers(head.partition(b"\r\n")[2])
    length = int(headers.get("content-length", ""))
    if len(rest) < length:
        raise ValueError("truncated block")
    if rest[length:] not in (b"", END.encode()):
        raise ValueError("block longer than stated")
    return headers, rest[:length]


def http_body(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """HTTP headers, payload as transferred, and body after transfer and content encoding."""
    import zlib

    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    headers = parse_headers(head.partition(b"\r\n")[2])
    body = payload
    if "chunked" in headers.get("transfer-encoding", "").lower():
        parts, rest = [], payload
        while rest:
            size, _, rest = rest.partition(b"\r\n")
            n = int(size.split(b";")[0].strip() or b"0", 16)
            if not n:
                break
            parts.append(rest[:n])
            rest = rest[n + 2 :]
        body = b"".join(parts)
    if headers.get("content-encoding", "").lower() in ("gzip", "deflate", "x-gzip"):
        packed, parts = body, []
        while packed:
            try:
                unpacking = zlib.decompressobj(47)
                parts.append(unpacking.decompress(packed))
            except zlib.error:
                if parts or headers["content-encoding"].lower() != "deflate":
                    raise
                unpacking = zlib.decompressobj(-15)  # deflate without its wrapping
                parts.append(unpacking.decompress(packed))
            if not unpacking.eof:
                raise ValueError("truncated body")
            # further gzip members follow each other; anything else behind the end is padding
            packed = unpacking.unused_data if unpacking.unused_data[:2] == b"\x1f\x8b" else b""
        if not parts:
            raise ValueError("truncated body")
        body = b"".join(parts)
    return headers, payload, body


#: Elements whose content is no text, and those that begin a new line.
HIDDEN = ("script", "style", "noscript", "template")
LINES = frozenset("p div h1 h2 h3 h4 h5 h6 li ul ol tr table section article header footer nav main blockquote pre title body html".split())
_NAME = re.compile(r"/?([a-z][a-z0-9]*)\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_ENDS = {n: re.compile(rf"</{n}\s*>", re.I) for n in (*HIDDEN, "title", "head")}
_ROOT = re.compile(r"[a-z][a-z0-9+.-]*://[^/?#]+", re.I)


def _absolute(href: str, base: str, root) -> str:
    from urllib.parse import urljoin

    if root and href[:1] == "/" and href[:2] != "//" and "/." not in href:
        return root[0] + href  # an absolute path without dot segments needs no more
    try:
        return urljoin(base, href)
    except ValueError:
        return href


def html_parts(page: str, base: str = "") -> tuple[str, str, str, list[dict[str, str]]]:
    """Plain text, title, language and links of an HTML page.

    One pass from tag to tag; nothing is looked for from the same place twice, so a page of
    unclosed tags takes time in proportion to its length.
    """
    from html import unescape

    body, links, link, title, lang, root = [], [], None, None, "", _ROOT.match(base)
    at, shown_from, head_ends = 0, 0, True

    def put(text: str, seen: str) -> None:
        """``seen`` goes to the page's text, unless that is in its head, ``text`` to the open link."""
        if at >= shown_from:
            body.append(seen)
        if link is not None:
            link[1].append(text)

    def close() -> None:
        nonlocal link
        if link is not None:
            links.append({"url": _absolute(unescape(link[0]).strip(), base, root), "text": " ".join(unescape("".join(link[1])).split())})
        link = None

    while True:
        begin = page.find("<", at)
        text = page[at:] if begin < 0 else page[at:begin]
        put(text, text)
        if begin < 0:
            break
        at = begin
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            if end < 0:
                break
            put(" ", " ")
            at = end + 3
            continue
        end = page.find(">", begin)
        if end < 0:
            # no tag ends any more; an element without text may still begin here
            found = re.search(rf"<!--|<(?:{'|'.join(HIDDEN)})\b", page[begin:], re.I)
            rest = page[begin : begin + found.start()] if found else page[begin:]
            put(rest, rest)
            break
        tag = page[begin + 1 : end]
        named = _NAME.match(tag)
        name, closing = (named[1].lower() if named else ""), tag.startswith("/")
        if name in HIDDEN and not closing:
            found = _ENDS[name].search(page, begin)
            if not found:
                break
            put(" ", " ")
            at = found.end()
            continue
        if name == "a":
            close()
        if name == "br" and closing:
            name = ""
        put(" ", "\n" if name in LINES or name == "br" else "")
        if not closing:
            if name == "a" and (href := _HREF.search(tag)):
                link = (href[1] or href[2] or href[3] or "", [])
            elif name == "title" and title is None:
                found = _ENDS[name].search(page, end)
                title = page[end + 1 : found.start()] if found else ""
            elif name == "html" and not lang and (found := _LANG.search(tag)):
                lang = found[1].lower()
            elif name == "head" and head_ends and begin >= shown_from:
                found = _ENDS[name].search(page, end)
                head_ends = bool(found)
                if found:
                    body.append(" ")
                    shown_from = found.end()
        at = end + 1
    close()
    lines = (" ".join(x.split()) for x in unescape("".join(body)).split("\n"))
    return "\n".join(x for x in lines if x), " ".join(unescape(title or "").split()), lang, links


def response_of(url: str | None, html: str | None, name: str, date: str = DATE) -> bytes:
    """A response record for a fetched page."""
    body = (html or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    uri = (url or "").replace("\r", "").replace("\n", "")
    return make_record(
        [("WARC-Type", "response"), ("WARC-Record-ID", identifier(name.encode(), uri.encode(), body)), ("WARC-Date", date), ("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block))],
        block,
    )


def derive_record(raw: bytes | None) -> list[dict]:
    """Rows of :data:`DERIVED` for one record."""
    import json

    try:
        if raw is None:
            raise ValueError("null record")
        headers, block = parse_record(raw)
        if headers.get("warc-type") != "response":
            return []
        http, payload, body = http_body(block)
    except Exception as e:  # any fault of the input becomes a row
        return [{"error": f"{type(e).__name__}: {e}"}]
    source, uri, date = headers.get("warc-record-id", ""), headers.get("warc-target-uri", ""), headers.get("warc-date", "")
    stated, found = headers.get("warc-payload-digest"), digest(payload)
    kind = http.get("content-type", "").lower()
    is_html = "html" in kind
    is_text = kind.startswith(CONVERTED)
    charset = kind.partition("charset=")[2].split(";")[0].strip(" \"'") or "utf-8"
    try:
        text = body.decode(charset, "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    plain, title, lang, links = html_parts(text, uri) if is_html else (text, "", "", [])
    common = {"refers_to": source, "target_uri": uri, "warc_date": date, "source_digest": stated or found, "source_digest_ok": stated in (None, found), "source_headers": list(http.items()), "n_links": len(links)}
    metadata_id, conversion_id = identifier(b"metadata", source.encode()), identifier(b"conversion", source.encode())
    told = {"title": title, "lang": lang, "links": links, "headers": http, "payload-digest": common["source_digest"], "conversion": conversion_id if is_text else None}
    made = [("metadata", metadata_id, "application/json", json.dumps(told, ensure_ascii=False, sort_keys=True))]
    if is_text:
        made.append(("conversion", conversion_id, "text/plain", plain))
    out = []
    for warc_type, own, content_type, content in made:
        data = content.encode("utf-8", "replace")
        mark = digest(data)
        fields = [("WARC-Type", warc_type), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source), ("WARC-Source-Payload-Digest", common["source_digest"]), ("WARC-Block-Digest", mark), ("Content-Type", content_type)]
        out.append(common | {"warc_type": warc_type, "record_id": own, "content_type": content_type, "content_length": len(data), "block_digest": mark, "content": data.decode(), "record": make_record(fields, data), "error": None})
    return out


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, record)``: a response record for each page."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, urls, pages_ = (c.to_pylist() for c in batch.columns)
            made = [response_of(u, h, str(i)) for i, u, h in zip(ids, urls, pages_)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=[id_col, "record"])

    picked = pages.select(id_col, url_col, html_col)
    return picked.mapInArrow(run, T.StructType([picked.schema.fields[0], T.StructField("record", T.BinaryType())]))


def derive(records: DataFrame, keep: list[str] = (), record_col: str = "record") -> DataFrame:
    """Derived records of each response, with the ``keep`` columns of its row."""
    picked = records.select(F.col(record_col).alias("_raw"), *keep)
    schema = T.StructType([*picked.schema.fields[1:], *(f for f in DERIVED.fields)])

    def run(batches):
        import pyarrow as pa

        types = {"content_length": pa.int64(), "n_links": pa.int64(), "source_digest_ok": pa.bool_(), "source_headers": pa.map_(pa.string(), pa.string()), "record": pa.binary()}
        for batch in batches:
            rows, of = [], []
            for i, raw in enumerate(bytes_of(batch.column(0))):
                made = derive_record(raw)
                rows += made
                of += [i] * len(made)
            kept = [c.take(pa.array(of, pa.int64())) for c in batch.columns[1:]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([r.get(n) for r in rows], types.get(n, pa.string())) for n in DERIVED.names)], names=schema.names)

    return picked.mapInArrow(run, schema)


def write_warc(records: DataFrame, path: str, record_col: str = "record") -> None:
    """Uncompressed WARC files, one for each partition."""
    records.filter(F.col(record_col).isNotNull()).select(F.col(record_col).cast("string").alias("value")).write.option("lineSep", END).text(path)


def unpacked(data: bytes) -> bytes:
    """What the gzip members of a file hold; a broken member is left out from its fault on."""
    import zlib

    out, at, step = [], 0, 1 << 16
    while 0 <= at < len(data):
        member, begin = zlib.decompressobj(31), at
        try:
            while at < len(data) and not member.eof:
                out.append(member.decompress(data[at : at + step]))
                at += step
            at = min(at, len(data)) - len(member.unused_data)
        except zlib.error:
            at = data.find(b"\x1f\x8b\x08", begin + 1)
    return b"".join(out)


def split_records(data: bytes) -> list[tuple[int, bytes]]:
    """(offset, record) of an uncompressed or gzipped WARC file; a record whose length is wrong reaches to the next line that begins one."""
    if data[:2] == b"\x1f\x8b":
        data = unpacked(data)
    mark, out, at = END.encode(), [], 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        try:
            end = head + 4 + int(parse_headers(data[at:head])["content-length"]) if head >= 0 else -1
        except (KeyError, ValueError):
            end = -1
        good = head + 4 <= end <= len(data) and (end == len(data) or data[end : end + 4] == mark and data[end + 4 : end + 9] in (b"", b"WARC/"))
        if not good:
            following = data.find(b"\nWARC/1.", at + 1)
            end = following + 1 if following >= 0 else len(data)
            out.append((at, data[at:end].removesuffix(mark)))
            at = end
        else:
            out.append((at, data[at:end]))
            at = end + 4
    return out


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(path, offset, record)`` of WARC files; each file is read whole by one task."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = split_records(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array([o for o, _ in found], pa.int64()), pa.array([r for _, r in found], pa.binary())], names=["path", "offset", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, offset long, record binary")
