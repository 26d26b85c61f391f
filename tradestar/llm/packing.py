"""Vector bin packing of tokenised examples into training sequences.

A sequence has several limits at once: tokens, segments (examples or pieces of them), and tokens that
bear loss.  An example is a vector of what it takes of each.  The open sequence
always gets the example that fits and has the largest dot product of its vector with the room
left, each limit weighted by how scarce it is among the examples at hand; when none
fits, the sequence is closed.  Examples of one shape (tokens, loss tokens) are one
choice, so a step costs one pass over the different shapes.

Text may be cut (``cut=True``): what fills whole sequences is taken off first, a
sequence that nothing fits into any more is filled with the head of the largest
example left, and the last sequence of a group is laid out in lengths that are
powers of two, which need no padding.  Without ``cut``, as for instruction data, an example stays
whole; only one that exceeds a limit by itself is cut, at that limit.

Each task packs what it reads, in groups of bounded size, as the rows arrive: there is no
shuffle, no group depends on a key, and a group's only loss is its last sequence.  A
sequence's number is made of the task's partition and a count, so a repeated task
gives the same rows.

Defined cases: a null or empty text has the end id only; an example without ids gives no piece;
a null loss mask means that every id bears loss; rows are independent, also of one id; an empty
table gives no pieces; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.llm.encoding import PieceEncoder

#: Tokens and examples that a task holds at a time.
GROUP_TOKENS = 4_000_000
GROUP_ITEMS = 50_000
#: Documents encoded at a time, and ids in an output batch.
AT_ONCE = 2_000
BATCH_IDS = 500_000
#: The shortest piece that a cut may make.
MIN_PIECE = 16
END_ID = 1


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Pool:
    """Items of a group (key, first id, tokens, loss tokens) by shape."""

    def __init__(self, limits: Limits):
        import numpy as np

        self.limits, self.place, self.items = limits, {}, []
        self.tokens, self.loss, self.left = (np.zeros(64, np.int64) for _ in range(3))
        self.total = np.zeros(3)

    def add(self, item: int, start: int, tokens: int, loss: int) -> None:
        import numpy as np

        at = self.place.get((tokens, loss))
        if at is None:
            at = self.place[tokens, loss] = len(self.items)
            self.items.append([])
            if at == len(self.left):
                self.tokens, self.loss, self.left = (np.append(a, np.zeros_like(a)) for a in (self.tokens, self.loss, self.left))
            self.tokens[at], self.loss[at] = tokens, loss
        self.items[at].append((item, start))
        self.left[at] += 1
        self.total += (tokens, 1, loss)

    def take(self, at: int) -> tuple[int, int, int, int]:
        self.left[at] -= 1
        tokens, loss = int(self.tokens[at]), int(self.loss[at])
        self.total -= (tokens, 1, loss)
        return (*self.items[at].pop(), tokens, loss)

    def best(self, room) -> int | None:
        """The shape that fits into ``room`` (tokens, segments, loss) and has the largest weighted dot product with it."""
        import numpy as np

        if room[1] < 1:
            return None
        n = len(self.items)
        fits = (self.left[:n] > 0) & (self.tokens[:n] <= room[0]) & (self.loss[:n] <= room[2])
        limit = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        weight = self.total / limit * room / limit**2
        score = np.where(fits, self.tokens[:n] * weight[0] + weight[1] + self.loss[:n] * weight[2], -1.0)
        at = int(score.argmax()) if n else 0
        return at if n and fits[at] else None

    def largest(self) -> int:
        import numpy as np

        n = len(self.items)
        return int(np.where(self.left[:n] > 0, self.tokens[:n], -1).argmax())


def head(loss, start: int, tokens: int, limits) -> tuple[int, int]:
    """Tokens and loss tokens of the longest piece from ``start`` on, of at most ``tokens``, that keeps ``limits`` (tokens, loss); ``loss`` None: all bear loss."""
    size = min(tokens, limits[0])
    if loss is None:
        return (min(size, limits[1]),) * 2
    import numpy as np

    seen = np.cumsum(loss[start : start + size])
    size = int(np.searchsorted(seen, limits[1], side="right"))
    return size, int(seen[size - 1]) if size else 0


def pack_group(masks: list, items: list[tuple[int, int, int, int]], limits: Limits, cut: bool) -> list[list[tuple[int, int, int, int]]]:
    """Sequences, each a list of pieces (item, first id, tokens, loss tokens), of a group of ``items`` like those pieces.

    ``masks`` holds each item's loss mask, or None.  An item keeps the limits by itself.
    """
    pool = Pool(limits)
    for item in items:
        pool.add(*item)
    left, out = len(items), []
    while left:
        import numpy as np

        room, pieces = np.array([limits.tokens, limits.segments, limits.loss]), []
        while left and (at := pool.best(room)) is not None:
            piece = pool.take(at)
            left -= 1
            pieces.append(piece)
            room -= (piece[2], 1, piece[3])
        if cut and left and room[1] > 0 and room[0] >= MIN_PIECE:
            item, start, tokens, loss = pool.take(pool.largest())
            size, bears = head(masks[item], start, min(tokens - MIN_PIECE, int(room[0])), (int(room[0]), int(room[2])))
            if size >= MIN_PIECE:
                pieces.append((item, start, size, bears))
                pool.add(item, start + size, tokens - size, loss - bears)
            else:
                pool.add(item, start, tokens, loss)
        out.append(pieces)
    if cut and out:
        out[-1:] = _powers(masks, out[-1])
    return out


def _powers(masks: list, pieces: list) -> list[list]:
    """The pieces of a sequence, laid out in sequences whose lengths are descending powers of two."""
    out, row, left = [], [], sum(p[2] for p in pieces)
    want = 1 << left.bit_length() - 1
    for item, start, tokens, loss in pieces:
        while tokens:
            size, bears = head(masks[item], start, tokens, (want, tokens))
            row.append((item, start, size, bears))
            start, tokens, want, left = start + size, tokens - size, want - size, left - size
            if not want:
                out.append(row)
                row, want = [], 1 << max(left.bit_length() - 1, 0)
    return out


_PIECES = "start long, length long, n_loss long, ids binary, doc_tokens long, sequence_id long, offset long"


def _packing(source, key_type, limits: Limits, cut: bool, group_tokens: int):
    """``source`` turns a batch into (key, ids, loss mask or None) for each example."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        names = ["key", *(c.split()[0] for c in _PIECES.split(", "))]
        types = [key_type, *([pa.int64()] * 3), pa.binary(), *([pa.int64()] * 3)]
        number = TaskContext.get().partitionId() << 33
        held, group, whole, tokens = [], [], [], 0

        def pieces():
            """The pieces of the group at hand, in batches; the group is empty afterwards."""
            nonlocal held, group, whole, tokens, number
            rows, size = [], 0
            for sequence in [*whole, *pack_group([h[2] for h in held], group, limits, cut)]:
                offset = 0
                for item, start, length, loss in sequence:
                    key, ids, _ = held[item]
                    rows.append((key, start, length, loss, ids[start : start + length].astype("<u4").tobytes(), len(ids), number, offset))
                    offset += length
                number, size = number + 1, size + offset
                if size >= BATCH_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            held, group, whole, tokens = [], [], [], 0

        for batch in batches:
            for key, ids, loss in source(batch):
                start = 0
                while start < len(ids):
                    length, bears = head(loss, start, len(ids) - start, (limits.tokens, limits.loss))
                    piece = (len(held), start, length, bears)
                    if length == limits.tokens:
                        whole.append([piece])
                    else:
                        group.append(piece)
                    start += length
                held.append((key, ids, loss))
                tokens += len(ids)
                if tokens >= group_tokens or len(held) >= GROUP_ITEMS:
                    yield from pieces()
        yield from pieces()

    return run


def pack_texts(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Texts, encoded and followed by ``end_id``, packed into sequences; cut where that saves padding, every id bearing loss.

    Returns one row for each piece: ``id_col``, start (ids of its document before it), length, n_loss,
    ids (little-endian unsigned 32-bit), doc_tokens (ids of its document), sequence_id, offset
    (ids before it in its sequence).
    """

    def source(batch):
        import numpy as np

        encoder = PieceEncoder(tokenizer, added_tokens=True)
        end = np.array([end_id], encoder.dtype).tobytes()
        for i in range(0, len(batch), AT_ONCE):
            part = batch.slice(i, AT_ONCE)
            encoded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            for key, ids in zip(part.column(0).to_pylist(), encoded):
                yield key, np.frombuffer(ids + end, encoder.dtype), None

    return _packed(docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").alias("text")), source, id_col, limits, True, group_tokens)


def pack_examples(examples: DataFrame, id_col: str = "id", ids_col: str = "ids", loss_col: str | None = None, limits: Limits = Limits(), cut: bool = False, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Tokenised examples packed into sequences: ``ids_col`` array of ids, ``loss_col`` array of booleans, true where an id bears loss.

    Returns the columns of :func:`pack_texts`.  A mask shorter than the ids is filled up with false.
    """

    def source(batch):
        import numpy as np

        masks = batch.column(2).to_pylist() if loss_col else [None] * len(batch)
        for key, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), masks):
            ids = np.array(ids or [], np.uint32)
            if loss is not None:
                loss = np.append(np.array([bool(x) for x in loss[: len(ids)]], np.int64), np.zeros(max(0, len(ids) - len(loss)), np.int64))
            yield key, ids, loss

    wanted = [F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{ids_col}`").cast("array<long>").alias("ids")]
    if loss_col:
        wanted.append(F.col(f"`{loss_col}`").cast("array<boolean>").alias("loss"))
    return _packed(examples.select(*wanted), source, id_col, limits, cut, group_tokens)


def _packed(rows: DataFrame, source, id_col: str, limits: Limits, cut: bool, group_tokens: int) -> DataFrame:
    import pyarrow as pa

    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("every limit must be at least 1")
    return rows.mapInArrow(_packing(source, pa.int64(), limits, cut, group_tokens), f"key long, {_PIECES}").withColumnRenamed("key", id_col)


def sequences(pieces: DataFrame, limits: Limits = Limits(), pad: bool = True) -> DataFrame:
    """One row for each sequence: sequence_id, length, padded_length (``limits.tokens``, or the length if that is a power of two), ids (of its pieces end to end), segments (their lengths), n_loss."""
    # at most limits.segments pieces of limits.tokens ids in all
    each = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "n_loss", "ids"))).alias("p"))
    length = F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x)
    loss = F.aggregate("p.n_loss", F.lit(0).cast("long"), lambda a, x: a + x)
    ids = F.unhex(F.array_join(F.transform("p.ids", lambda x: F.hex(x)), ""))
    power = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    out = each.select("sequence_id", length.alias("length"), ids.alias("ids"), F.col("p.length").alias("segments"), loss.alias("n_loss"))
    return out.withColumn("padded_length", F.when(power if pad else F.lit(True), F.col("length")).otherwise(limits.tokens))
