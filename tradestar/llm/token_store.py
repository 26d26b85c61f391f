"""Token ids as raw binary shards with a minimal-perfect-hash index for keyed access.

Documents are dealt out in key order, encoded, and each task writes one file of
segments: the raw ids of its documents (little-endian, 16 bits if the vocabulary
fits, else 32; an end id after each document), then the segment's index and a
footer.  The index is a minimal perfect hash of the segment's keys with a stored
fingerprint for each key, and maps a key to its records' places among the raw ids in
constant time: a look-up reads one block of bits of a level or more, a fingerprint, and the record itself,
of the one segment whose range of keys holds the key.  Files are written by Spark's own writer (a task that is repeated
leaves one copy) and read by Spark's own reader, so any store that Spark reaches
will do; a directory of one row per file routes a key to its file.

Pre-tokens are found by array operations over a batch of texts, and each different
one is encoded once (``encoding.py``).

A text may hold the string of one of the vocabulary's added tokens.  With
``added_tokens`` that string has its own id, as in a plain ``encode``, and such a text
goes to the tokenizer whole; without, it is ordinary text.

Defined cases: a null or empty text has the end id only; records of one key stand
together, ordered by a hash of the text; a null key stands first and is found by
``scan`` only; an empty table makes a store without records; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradestar.llm import mph
from tradestar.llm.encoding import PieceEncoder
from tradestar.session import materialize

END_ID = 2
#: Text in one file, and raw ids in one segment, in bytes; documents in one file.  Spark reads a file
#: back as one value, copied several times on its way to the worker, so files are kept small.
SHARD_BYTES = 8_000_000
SEGMENT_BYTES = 8_000_000
SHARD_DOCS = 200_000
#: Documents encoded at a time.
AT_ONCE = 4_000
MAGIC = b"TSIDS001"
FOOTER = 32


def pack_segment(keys, payloads: list[bytes], end: bytes) -> bytes:
    """One segment.  ``keys``: sorted, None first."""
    import numpy as np

    known = np.array([k for k in keys if k is not None], dtype=np.int64)
    nulls = len(keys) - len(known)
    each, first, count = np.unique(known, return_index=True, return_counts=True)
    levels = mph.build(each)
    at = mph.slots(levels, each)
    marks, firsts, counts = np.empty(len(each), "<u4"), np.empty(len(each), "<u8"), np.empty(len(each), "<u8")
    marks[at], firsts[at], counts[at] = mph.fingerprint(each), first + nulls, count
    body = end.join([*payloads, b""])
    starts = np.cumsum([0, *(len(p) // len(end) + 1 for p in payloads)]).astype("<u8")
    head = np.array([len(keys), nulls, len(each), len(levels), len(end), *(w for w, _, _ in levels)], dtype="<u8")
    index = b"".join([head.tobytes(), *(b.tobytes() + r.tobytes() for _, b, r in levels), marks.tobytes(), firsts.tobytes(), counts.tobytes(), starts.tobytes(), known.astype("<i8").tobytes()])
    return body + index + MAGIC + np.array([len(body), len(index), len(body) + len(index) + FOOTER], dtype="<u8").tobytes()


class Segment:
    """Index and raw ids of a segment; ``find`` gives the records of keys in constant time each."""

    def __init__(self, data, end: int):
        import numpy as np

        assert bytes(data[end - FOOTER : end - 24]) == MAGIC, "not a segment"
        self.body, index, self.size = np.frombuffer(data, "<u8", 3, end - 24).tolist()
        at = end - FOOTER - index
        self.records, self.nulls, n, n_levels, self.width = np.frombuffer(data, "<u8", 5, at).tolist()
        widths = np.frombuffer(data, "<u8", n_levels, at + 40).tolist()
        at += 40 + 8 * n_levels
        self.levels = []
        for w in widths:
            blocks = -(-w // mph.BLOCK)
            bits = blocks * mph.BLOCK // 8
            self.levels.append((w, np.frombuffer(data, np.uint8, bits, at), np.frombuffer(data, "<u8", blocks, at + bits)))
            at += bits + 8 * blocks
        # views of the file: nothing is copied or widened here
        self.marks = np.frombuffer(data, "<u4", n, at)
        self.firsts, self.counts = np.frombuffer(data, "<i8", n, at + 4 * n), np.frombuffer(data, "<i8", n, at + 12 * n)
        self.starts = np.frombuffer(data, "<i8", self.records + 1, at + 20 * n)
        self.keys = np.frombuffer(data, "<i8", self.records - self.nulls, at + 20 * n + 8 * (self.records + 1))
        begin = end - self.size
        self.ids = np.frombuffer(data, f"<u{self.width}", self.body // self.width, begin)

    def find(self, keys):
        """(found, first record, number of records) of each key.

        The fingerprint turns other keys away; the key of the record itself settles the one in 2^32 that it lets through.
        """
        import numpy as np

        found, first, count = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if not len(self.marks):
            return found, first, count
        here = np.flatnonzero((keys >= self.keys[0]) & (keys <= self.keys[-1]))
        slot = np.maximum(mph.slots(self.levels, keys[here]), 0)
        same = self.marks[slot] == mph.fingerprint(keys[here])
        here, slot = here[same], slot[same]
        at = self.firsts[slot]
        same = self.keys[at - self.nulls] == keys[here]
        here, slot = here[same], slot[same]
        found[here], first[here], count[here] = True, self.firsts[slot], self.counts[slot]
        return found, first, count


def segments(data) -> list[Segment]:
    """Segments of a file, in order (each is followed by a line feed)."""
    out, end = [], len(data) - 1
    while end > 0:
        out.append(Segment(data, end))
        end -= out[-1].size + 1
    return out[::-1]


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, segment_bytes: int = SEGMENT_BYTES, added_tokens: bool = False) -> DataFrame:
    """Write the ids of all documents in ascending ``id_col`` order to ``path``/ids, and the directory to ``path``/directory.

    Returns the records as read back from the files for the directory, see :func:`scan`.
    """
    size, rows = docs.agg(F.sum(F.octet_length(text_col)), F.count("*")).first()
    shards = max(1, -(-(size or 0) // shard_bytes), -(-rows // SHARD_DOCS))
    tie = F.xxhash64("text")
    keyed = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    dealt = keyed.repartitionByRange(shards, "key", tie).sortWithinPartitions("key", tie)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encoder = PieceEncoder(tokenizer, added_tokens)
        end = np.array([end_id], encoder.dtype).tobytes()
        keys, payloads, held = [], [], 0
        for batch in batches:
            for i in range(0, len(batch), AT_ONCE):
                part = batch.slice(i, AT_ONCE)
                encoded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                for key, ids in zip(part.column(0).to_pylist(), encoded):
                    keys.append(key)
                    payloads.append(ids)
                    held += len(ids) + len(end)
                    if held >= segment_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([pack_segment(keys, payloads, end)], pa.binary())], names=["segment"])
                        keys, payloads, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([pack_segment(keys, payloads, end)], pa.binary())], names=["segment"])

    # the text writer puts the bytes of a string down as they are
    dealt.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/ids")
    found = materialize(_files(docs.sparkSession, [f"{path}/ids"]).mapInArrow(_reading(), _RECORD), "token_records")
    each = found.groupBy("file").agg(F.first("name").alias("name"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("n_tokens").alias("n_ids"))
    # one row for each file of about shard_bytes of text
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each.withColumn("base", before).write.parquet(f"{path}/directory")
    return _with_start(found, path)


def _with_start(found: DataFrame, path: str) -> DataFrame:
    base = found.sparkSession.read.parquet(f"{path}/directory").select("file", "base")
    return found.join(base, "file").withColumn("start", F.col("base") + F.col("offset"))


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths).select("path", "content")


_RECORD = "file long, name string, doc_id long, offset long, n_tokens long, ids_crc32 long"


def _reading(wanted=None, with_ids: bool = False):
    """Records of the files: those of the ``wanted`` keys, or all; each found through its segment's index."""

    def run(batches):
        import re
        from zlib import crc32

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_buffer()
                number = int(re.search(r"part-(\d+)", name.rsplit("/", 1)[-1])[1])
                base = 0
                for s in segments(data):
                    found, first, count = s.find(np.unique(s.keys) if wanted is None else wanted)
                    first, count = first[found], count[found]
                    record = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    if wanted is None:
                        record = np.concatenate([np.arange(s.nulls), record])
                    lo, hi = s.starts[record], s.starts[record + 1]
                    spans = [s.ids[a:b].astype("<u4") for a, b in zip(lo.tolist(), hi.tolist())]
                    keys = [None if r < s.nulls else int(s.keys[r - s.nulls]) for r in record.tolist()]
                    columns = [
                        pa.array([number] * len(record), pa.int64()),
                        pa.array([name] * len(record), pa.string()),
                        pa.array(keys, pa.int64()),
                        pa.array(base + lo, pa.int64()),
                        pa.array(hi - lo, pa.int64()),
                        pa.array(map(crc32, spans), pa.int64()),
                    ]
                    names = ["file", "name", "doc_id", "offset", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in spans], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    base += len(s.ids)

    return run


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Every record, read back from the files: file, name, doc_id, offset in the file, n_tokens, ids_crc32, and start among all ids."""
    return _with_start(_files(spark, [f"{path}/ids"]).mapInArrow(_reading(), _RECORD), path)


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Records of a stated list of keys with their ids; only files whose range holds a key are read."""
    import numpy as np

    wanted = np.unique(np.array(keys, dtype=np.int64))
    asked = spark.createDataFrame([(int(k),) for k in wanted], "key long")
    directory = spark.read.parquet(f"{path}/directory")
    names = [r.name for r in directory.join(F.broadcast(asked), F.col("key").between(F.col("low"), F.col("high")), "left_semi").select("name").collect()]
    if not names:
        return spark.createDataFrame([], f"{_RECORD}, ids array<long>, start long")
    found = _files(spark, names).mapInArrow(_reading(wanted, True), f"{_RECORD}, ids array<long>")
    return found.join(F.broadcast(directory.filter(F.col("name").isin(names)).select("file", "base")), "file").withColumn("start", F.col("base") + F.col("offset")).drop("base")
