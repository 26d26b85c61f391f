"""SimHash near-dedup: tiled exact comparison of fingerprints.

Equal texts collapse to one fingerprint first.  The distinct fingerprints are
laid out in tiles by the population counts of their four 16-bit quarters; two
fingerprints within ``radius`` bits cannot lie in tiles whose counts differ by
more than ``radius`` in sum, so only the remaining tile pairs are compared, with
numpy exclusive-or and bit counts.  Every link between different fingerprints is
found; a task emits a spanning forest of its links, never all pairs of a group.
Connected components then come from alternating star contractions, each written
as a table, so no step holds a component, and none passes through the driver.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; a repeated row gets its own result row; a null doc_id gets a result row
but never names a component (null if the whole component has none); an empty
table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.common import bytes_of, numbered
from tradestar.session import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
SEGMENTS = 4
#: Fingerprints of a tile held by one task at a time; larger tiles are dealt out.
TILE_ROWS = 4096
#: Links kept in a task before they are reduced to a forest.
LINKS_HELD = 500_000


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp)``: the 64-bit SimHash of each text as a long, one row per input row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        from itertools import islice, repeat

        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        lanes = np.arange(8, dtype=np.int64) * 256
        for batch in batches:
            out = np.zeros(len(batch), dtype=np.uint64)
            for i, text in enumerate(bytes_of(batch.column(1))):
                words = text.lower().split() if text else ()
                if not words:
                    continue
                if len(words) <= shingle:
                    parts, n = [b" ".join(words)], 1
                else:
                    parts, n = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle)))), len(words) - shingle + 1
                h = np.fromiter(map(digest, parts, repeat(seed)), dtype=np.uint64, count=n)
                counts = np.bincount((h.view(np.uint8).reshape(n, 8) + lanes).ravel(), minlength=2048).reshape(8, 256) @ bits
                out[i] = np.packbits((2 * counts > n).ravel(), bitorder="little").view(np.uint64)[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _quarter_counts(fp: Column) -> list[Column]:
    width = 64 // SEGMENTS
    return [F.bit_count(F.shiftrightunsigned(fp, s * width).bitwiseAND((1 << width) - 1)) for s in range(SEGMENTS)]


def _tile(counts: list[Column]) -> Column:
    base = 64 // SEGMENTS + 1
    code = F.lit(0)
    for c in counts:
        code = code * base + c
    return code.cast("int")


def _reachable(radius: int) -> list[tuple[int, ...]]:
    """Differences of population counts that two linked fingerprints can have: one of each opposite pair, and none."""
    deltas = (d for d in product(range(-radius, radius + 1), repeat=SEGMENTS) if sum(map(abs, d)) <= radius)
    return [d for d in deltas if d >= (0,) * SEGMENTS]


def forest(u, v):
    """Spanning forest of links ``u[i] - v[i]`` as arrays (node, smallest node of its tree), roots left out."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label[label] != label).any():
            label = label[label]
    kept = label != np.arange(len(nodes))
    return nodes[kept], nodes[label[kept]]


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(u, v)``: a spanning set of the links between distinct fingerprints (column ``fp``) within ``radius`` bits."""
    counts = [f"_c{s}" for s in range(SEGMENTS)]
    top = 64 // SEGMENTS
    placed = fps.select("fp", *[c.alias(n) for c, n in zip(_quarter_counts(F.col("fp")), counts)])
    own = placed.withColumn("tile", _tile([F.col(c) for c in counts]))
    # at most (64 / SEGMENTS + 1) ** SEGMENTS = 83,521 rows, whatever the input
    parts = own.groupBy("tile").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    home = own.join(F.broadcast(parts), "tile").select("tile", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("kind"), "fp")
    moves = [
        F.when(
            F.lit(True) if not any(d) else F.expr(" AND ".join(f"{c} - ({x}) BETWEEN 0 AND {top}" for c, x in zip(counts, d))),
            _tile([F.col(c) - x for c, x in zip(counts, d)]),
        )
        for d in _reachable(radius)
    ]
    visits = (
        placed.select("fp", F.explode(F.array_compact(F.array(*moves))).alias("tile"))
        .join(F.broadcast(parts), "tile")
        .select("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "fp")
    )
    dealt = home.unionByName(visits).repartition("tile", "part").sortWithinPartitions("tile", "part", "kind")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held_u, held_v, held = [], [], 0

        def reduce():
            nonlocal held_u, held_v, held
            u, v = forest(np.concatenate(held_u), np.concatenate(held_v))
            held_u, held_v, held = [u], [v], len(u)

        def compare(mine, theirs):
            nonlocal held
            for i in range(0, len(mine), 256):
                a = mine[i : i + 256]
                for j in range(0, len(theirs), 4096):
                    b = theirs[j : j + 4096]
                    x = np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64))  # of signed numbers it would count the absolute value
                    r, c = np.nonzero((x <= radius) & (x > 0))
                    if len(r):
                        held_u.append(a[r])
                        held_v.append(b[c])
                        held += len(r)
                        if held > LINKS_HELD:
                            reduce()

        key, mine = None, np.empty(0, np.int64)
        for batch in batches:
            tile, part, kind, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(fp):
                continue
            turns = np.flatnonzero((np.diff(tile) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *turns], [*turns, len(fp)]):
                if key != (tile[lo], part[lo]):
                    key, mine = (tile[lo], part[lo]), np.empty(0, np.int64)
                if kind[lo] == 0:
                    mine = np.concatenate([mine, fp[lo:hi]])
                else:
                    compare(mine, fp[lo:hi])
        if held:
            reduce()
            for i in range(0, len(held_u[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(held_u[0][i : i + 100_000]), pa.array(held_v[0][i : i + 100_000])], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``: root is the smallest node reachable.

    Alternating star contractions.  The smallest neighbour of each node is a
    combined aggregate stored as a table, so the joins are plain ones whose hot
    nodes adaptive execution can split.
    """
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star_low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(large.filter("u <> v").distinct(), "star_large")
        low = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "star_low")
        small = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u <> v").distinct(), "star_small")
        if mark == (mark := _mark(edges)):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fp`` (long) and ``component_id``, the smallest id reachable over links of ``radius`` bits or fewer."""
    marked = materialize(fingerprints(docs, shingle, seed, id_col, text_col), "simhash")
    distinct = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("low")), "simhash_distinct")
    linked = materialize(components(links(distinct, radius)), "simhash_linked")
    lows = linked.join(distinct, linked["node"] == distinct["fp"]).groupBy("root").agg(F.min("low").alias("component_id"))
    named = linked.join(lows, "root").select(F.col("node").alias("fp"), "component_id")
    of = materialize(distinct.join(named, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id")), "simhash_components")
    return marked.join(of, "fp").select(id_col, "fp", "component_id")


def _row_order(text_col: str, row: str = "_row") -> Column:
    """Text first, then the other columns as JSON (any type has that form)."""
    return F.struct(F.col(f"{row}.`{text_col}`"), F.to_json(row))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: one with the smallest id, a null id being larger than all.

    Of several texts with that id in a group, one is kept (the smallest SHA-256 of id
    and text); of rows equal in id and text, the smallest of the other columns.  A text
    that resembles no other one stays, also if its id is repeated.
    """
    names = docs.columns
    docs, (id_col, text_col) = numbered(docs, id_col, text_col)
    named = F.col(id_col).cast("string")
    key = F.sha2(F.concat_ws(":", F.col(id_col).isNull().cast("string"), F.length(named).cast("string"), named, text_col), 256)
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(key.alias("_key"), id_col, F.struct(text_col, *rest).alias("_row"))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), key.alias("key"))
    marked = materialize(fingerprints(docs.select(order.alias("_rank"), text_col), shingle, seed, "_rank", text_col), "simhash_rows")
    distinct = materialize(marked.groupBy("fp").agg(F.min("_rank").alias("low")), "simhash_lowest")
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    lowest = distinct.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("low").alias("low"))
    kept = rows.groupBy("_key").agg(F.min(id_col).alias(id_col), F.min_by("_row", _row_order(text_col)).alias("_row"))
    kept = kept.join(materialize(lowest.select(F.col("low.key").alias("_key")), "simhash_kept"), "_key", "left_semi")
    return kept.select(*[F.col(id_col) if c == id_col else F.col(f"_row.`{c}`") for c in docs.columns]).toDF(*names)
