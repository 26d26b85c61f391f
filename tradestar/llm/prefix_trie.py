"""Prefix trie of conversations, from range minima over the common prefixes of sorted neighbours.

A conversation is its sequence of turns, a turn the 128-bit digest of its role and
text.  The *distinct* sequences are sorted (a shuffle by range; copies are counted, not
sorted along) and cut into blocks of neighbours.  A block computes the length of the
prefix that each row shares with the row above it, a sparse table of range minima over
these lengths, and for every candidate prefix, i.e. each row and depth, the first and
last row of the interval of rows that share it: two binary searches over the sparse
table that need nothing of each other.  A node is the candidate at the first row of its
interval, and everything about it is a difference of running sums (or a range minimum)
over the interval.

An interval that goes on in a neighbouring block is *open* there.  Its measures are sums
of what each block counts for its own rows (a child or leaf is counted where it begins),
so the few open nodes are put together by a grouping on their digest.  Nothing is held
for a whole node: a prefix that a third of all conversations share is one open node in
each block.

The hash of a node's ended conversations reads their ids in ascending order, however
many there are: rows are sorted by (sequence, id) over all tasks; a sequence that lies
inside one task with few ids is hashed there; any other leaves its ids as rows of about
``CHUNK`` ids each, which one task then streams through the hash (a SHA-256 is
sequential by its definition; the ids are never held together).

Defined cases: turns stand in ascending ``turn``, null first, then by role and text; a null
role or text is empty; a row whose conversation id is null belongs to no conversation; an empty
table has no nodes, not even the root; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradestar.llm.common import SPACES
from tradestar.session import materialize

#: Rows, and bytes of digests, in one block.
BLOCK_ROWS = 50_000
BLOCK_BYTES = 16_000_000
#: Joined ids in one row of a sequence that has many, or spans tasks (about 16 kB).
CHUNK = 2_000
#: Bytes of a turn's digest.
CELL = 16
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, first_rank long, last_rank long"
_PARTIAL = NODES + ", node binary, parent binary"


def sequences(turns: DataFrame) -> DataFrame:
    """One row for each conversation of (conv_id, turn, role, text): conv_id, ``keys`` (hex digests of its turns) and ``words`` (words of their texts)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    clean = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    # the window streams the sorted texts; only digests are collected, in the same partitioning
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    key = F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * CELL)
    words = F.regexp_count("text", F.lit(f"[^{SPACES}]+"))
    placed = clean.select("conv_id", F.row_number().over(order).alias("place"), key.alias("key"), words.cast("int").alias("words"))
    each = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "key", "words"))).alias("t"))
    return each.select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def with_shared_heads(found: DataFrame, every: int = 20, at_most: int = 3) -> DataFrame:
    """Conversations rebuilt: the first h turns of the conversation with the next lower multiple of ``every`` as id, then the own turns after the first h; h is the id's crc32 modulo ``at_most`` + 1."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = found.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("keys", 1, at_most).alias("head_keys"), F.slice("words", 1, at_most).alias("head_words"))
    joined = found.withColumn("base", base).join(heads, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (at_most + 1)).cast("int")

    def rebuilt(own: str, head: str, kind: str):
        first = F.coalesce(F.slice(F.col(head), F.lit(1), h), F.array().cast(kind))
        rest = F.when(h >= F.size(own), F.array().cast(kind)).otherwise(F.slice(F.col(own), h + 1, F.size(own)))
        return F.concat(first, rest)

    return joined.select("conv_id", rebuilt("keys", "head_keys", "array<string>").alias("keys"), rebuilt("words", "head_words", "array<int>").alias("words"))


_RUN = "seq binary, words array<int>, n long, low long, sha string, ids binary"


def _run_rows(rows):
    import pyarrow as pa

    types = [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["seq", "words", "n", "low", "sha", "ids"])


def _runs(batches):
    """Rows sorted by (seq, conv_id): one row with the hash for a sequence that begins and ends here and has few ids, else rows of joined ids."""
    import hashlib

    seq, words, ids, whole, out = None, None, [], False, []

    def row(done: bool):
        text = ",".join(map(str, ids)).encode()
        return (seq, words, len(ids), ids[0], hashlib.sha256(text).hexdigest() if done else None, None if done else text)

    for batch in batches:
        column = batch.column(2)
        for i, (s, c) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if s != seq or len(ids) >= CHUNK:
                if seq is not None:
                    out.append(row(whole and s != seq))
                # the first sequence of a task may have begun in another, a full chunk goes on here
                whole = seq is not None and s != seq
                seq, words, ids = s, column[i].as_py(), []
            ids.append(c)
        if len(out) > 1000:
            yield _run_rows(out)
            out = []
    if seq is not None:
        out.append(row(False))
    if out:
        yield _run_rows(out)


def _streamed(batches):
    """Rows of joined ids, sorted by (seq, low), to one row for each sequence."""
    import hashlib

    seq, words, n, low, digest = None, None, 0, None, None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["seq"] != seq:
                if seq is not None:
                    out.append((seq, words, n, low, digest.hexdigest(), None))
                seq, words, n, low, digest = r["seq"], r["words"], 0, r["low"], hashlib.sha256()
            digest.update(r["ids"] if n == 0 else b"," + r["ids"])
            n += r["n"]
        if out:
            yield _run_rows(out)
    if seq is not None:
        yield _run_rows([(seq, words, n, low, digest.hexdigest(), None)])


def distinct_sequences(found: DataFrame) -> DataFrame:
    """Each different sequence of ``found`` (conv_id, keys, words) once: seq, words, n conversations, low (their smallest id), sha (of their ids)."""
    seq = F.unhex(F.array_join("keys", ""))
    rows = found.select(seq.alias("seq"), "conv_id", "words").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    runs = materialize(rows.mapInArrow(_runs, _RUN), "trie_runs")
    broken = runs.filter("sha IS NULL").repartition("seq").sortWithinPartitions("seq", "low").mapInArrow(_streamed, _RUN)
    return runs.filter("sha IS NOT NULL").unionByName(broken).drop("ids")


def _range_minima(values):
    """Sparse table: row k holds the minima over 2^k neighbours."""
    import numpy as np

    table, step = [values], 1
    while 2 * step <= len(values):
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        step *= 2
    return table


def _extent_right(table, row, depth, last: int):
    """Last row of the run from ``row`` on whose shared prefixes are all at least ``depth`` (``table`` over the lengths shared with the row above)."""
    import numpy as np

    at = row.copy()
    for k in reversed(range(len(table))):
        to = at + (1 << k)
        ok = to <= last
        ok[ok] = table[k][at[ok] + 1] >= depth[ok]
        at = np.where(ok, to, at)
    return at


def _extent_left(table, row, depth):
    """First row of the run up to ``row``."""
    import numpy as np

    at = row.copy()
    for k in reversed(range(len(table))):
        to = at - (1 << k)
        ok = to >= 0
        ok[ok] = table[k][to[ok] + 1] >= depth[ok]
        at = np.where(ok, to, at)
    return at


def _minimum(table, first, last):
    """Minimum of the values from ``first`` to ``last``."""
    import numpy as np

    k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), np.int64)
    for level in np.unique(k):
        at = k == level
        out[at] = np.minimum(table[level][first[at]], table[level][last[at] - (1 << level) + 1])
    return out


def _shared(cells, starts, lengths):
    """Number of leading cells that each row shares with the one above it (0 for the first)."""
    import numpy as np

    out = np.zeros(len(lengths), np.int64)
    both = np.minimum(lengths[:-1], lengths[1:])
    pair = np.repeat(np.arange(len(both)), both)
    within = np.arange(len(pair)) - np.repeat(np.cumsum(both) - both, both)
    same = (cells[starts[pair] + within] == cells[starts[pair + 1] + within]).all(axis=1)
    ends = np.where(same, both[pair], within)
    some = both > 0
    if len(pair):
        out[1:][some] = np.minimum.reduceat(ends, (np.cumsum(both) - both)[some])
    return out


def _chain(seq: bytes) -> list[bytes]:
    """Digests of a row's prefixes, by depth."""
    import hashlib

    state, out = hashlib.sha256(), []
    out.append(state.digest())
    for at in range(0, len(seq), CELL):
        state.update(seq[at : at + CELL])
        out.append(state.digest())
    return out


def block_nodes(seqs: list[bytes], words, n, low, sha: list[str], above: int, below: int, rank: int):
    """Nodes of a block of sorted rows, as columns of ``_PARTIAL``.

    ``above``: cells that the first row shares with the row above the block, -1 if there is
    none; ``below``: the same of the row after the last; ``rank``: rows above the block.
    """
    import hashlib

    import numpy as np
    import pyarrow as pa

    lengths = np.array([len(s) // CELL for s in seqs], np.int64)
    starts = np.cumsum(lengths) - lengths
    cells = np.array(bytearray(b"".join(seqs)), np.uint8).view(np.uint64).reshape(-1, 2)
    shared = _shared(cells, starts, lengths)
    table = _range_minima(shared)
    shared[0] = above
    following = np.append(shared[1:], below)

    # every row at every depth is a candidate
    base = np.cumsum(lengths + 1) - (lengths + 1)
    row = np.repeat(np.arange(len(seqs)), lengths + 1)
    depth = np.arange(len(row)) - base[row]
    first = _extent_left(table, row, depth)
    last = _extent_right(table, row, depth, len(seqs) - 1)
    parent = np.where(depth > 0, base[np.append(0, first[:-1])] + depth - 1, -1)  # the candidate of depth - 1 stands just before
    node = first == row
    own = shared[row] < depth  # begins here, not in a block above
    children = np.bincount(parent[node & own & (depth > 0)], minlength=len(row))

    flat = np.append(0, np.cumsum(words.astype(np.int64)))

    def words_before(r, d):
        """Words in the first d turns of row r."""
        return flat[starts[r] + d] - flat[starts[r]]

    every = np.arange(len(seqs))
    total = words_before(every, lengths)
    copies, weight = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * total))
    leaves = np.append(0, np.cumsum(following < lengths))
    new = np.append(0, np.cumsum(total - words_before(every, np.maximum(shared, 0))))  # words of the nodes that begin at each row

    at = np.flatnonzero(node)
    r, d, e = row[at], depth[at], last[at]
    top = np.maximum(d - 1, 0)
    members = copies[e + 1] - copies[r]
    once = new[e + 1] - new[r + 1] + total[r] - words_before(r, np.maximum(top, shared[r]))
    saved = weight[e + 1] - weight[r] - members * words_before(r, top) - once
    lowest = _minimum(_range_minima(low), r, e)
    opened = ((r == 0) & (d <= above)) | ((e == len(seqs) - 1) & (d <= below))

    up = parent[at]
    closed_parent = np.full(len(row), -1, np.int64)
    closed_parent[at] = np.where(opened, -1, lowest)
    parent_low = np.where(up >= 0, closed_parent[up], -1)
    has_parent = up >= 0
    open_of = np.zeros(len(row), bool)
    open_of[at] = opened
    parent_open = has_parent & open_of[np.maximum(up, 0)]

    chains = {0: _chain(seqs[0])} if above >= 0 else {}
    if below >= 0:
        chains[len(seqs) - 1] = _chain(seqs[-1])

    def digest(i: int) -> bytes:
        """Digest of the prefix of an open node: one of the first or of the last row."""
        chain = chains[0] if row[i] == 0 and depth[i] <= above else chains[len(seqs) - 1]
        return chain[depth[i]]

    none = hashlib.sha256(b"").hexdigest()
    ends = [sha[i] if lengths[i] == k and o else (None if is_open else none) for i, k, o, is_open in zip(r.tolist(), d.tolist(), own[at].tolist(), opened.tolist())]
    columns = [
        pa.array(lowest, pa.int64()),
        pa.array(d, pa.int64()),
        pa.array(parent_low, pa.int64(), mask=~has_parent | parent_open),
        pa.array(members, pa.int64()),
        pa.array(children[at], pa.int64()),
        pa.array(leaves[e + 1] - leaves[r], pa.int64()),
        pa.array(saved, pa.int64()),
        pa.array(ends, pa.string()),
        pa.array(r + rank, pa.int64()),
        pa.array(e + rank, pa.int64()),
        pa.array([digest(i) if o else None for i, o in zip(at.tolist(), opened.tolist())], pa.binary()),
        pa.array([digest(i) if o else None for i, o in zip(np.maximum(up, 0).tolist(), parent_open.tolist())], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PARTIAL.split(", ")])


def _blocks(edges: dict):
    """``edges``: block -> (above, below, rank)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, block = [], None

        def nodes():
            t = pa.Table.from_batches(held).combine_chunks()
            column = {c: t.column(c).combine_chunks() if t.num_rows else t.column(c) for c in t.column_names}
            words = column["words"].flatten().to_numpy(zero_copy_only=False)
            return block_nodes(column["seq"].to_pylist(), words, column["n"].to_numpy(), column["low"].to_numpy(), column["sha"].to_pylist(), *edges[block])

        for batch in batches:
            marks = batch.column(0).to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(marks)) + 1, len(marks))
            begin = 0
            for end in cuts.tolist():
                if end == begin:
                    continue
                if block is not None and marks[begin] != block:
                    yield nodes()
                    held = []
                block = int(marks[begin])
                held.append(batch.slice(begin, end - begin))
                begin = end
        if held:
            yield nodes()

    return run


def _edge(batches):
    """Cells that a block's first row shares with the last row of the block above."""
    import pyarrow as pa

    for batch in batches:
        shared = []
        for low, above in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if above is None:
                shared.append(-1)
                continue
            k = 0
            while k < min(len(low), len(above)) and low[k : k + CELL] == above[k : k + CELL]:
                k += CELL
            shared.append(k // CELL)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64())], names=["block", "n_rows", "shared"])


def trie(found: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Nodes of the prefix trie of ``found`` (conv_id, keys, words: see :func:`sequences`).

    One row for each different prefix, the empty one included: conv_id (smallest member), depth,
    parent_conv_id (smallest member of the prefix one shorter), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, members beyond the first times the words of the last
    turn), ends_sha256 (of the ids that end here), and first_rank and last_rank, the
    member interval among the sorted different sequences.
    """
    each = distinct_sequences(found)
    size = each.agg(F.count("*"), F.sum(F.octet_length("seq"))).first()
    blocks = max(1, -(-size[0] // block_rows), -(-(size[1] or 0) // block_bytes))
    cut = materialize(each.repartitionByRange(blocks, "seq").withColumn("block", F.spark_partition_id()), "trie_sequences")
    # one row for each block
    bounds = cut.groupBy("block").agg(F.count("*").alias("n_rows"), F.min("seq").alias("low"), F.max("seq").alias("high"))
    above = bounds.select("block", "n_rows", "low", F.lag("high").over(Window.orderBy("block")).alias("above"))
    shared = sorted((r.block, r.n_rows, r.shared) for r in above.mapInArrow(_edge, "block int, n_rows long, shared long").collect())
    edges, rank = {}, 0
    for i, (block, rows, before) in enumerate(shared):
        edges[block] = (before, shared[i + 1][2] if i + 1 < len(shared) else -1, rank)
        rank += rows
    rows = cut.select("block", "seq", "words", "n", "low", "sha").repartition(blocks, "block").sortWithinPartitions("block", "seq")
    parts = materialize(rows.mapInArrow(_blocks(edges), _PARTIAL), "trie_nodes")

    measures = [F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends_sha256").alias("ends_sha256"), F.min("first_rank").alias("first_rank"), F.max("last_rank").alias("last_rank"), F.first("parent").alias("parent")]
    joined = materialize(parts.filter("node IS NOT NULL").groupBy("node", "depth").agg(*measures), "trie_open")
    names = [c.split()[0] for c in NODES.split(", ")]
    closed = parts.filter("node IS NULL")
    # the parent of an open node is open, too
    rest = closed.filter("parent IS NOT NULL").drop("node", "parent_conv_id").unionByName(joined.filter("depth > 0").drop("node"))
    known = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = joined.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = closed.filter("parent IS NULL").select(names).unionByName(rest.join(known, "parent").select(names)).unionByName(root.select(names))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)))
