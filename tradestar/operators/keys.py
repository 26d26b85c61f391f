"""Dense surrogate keys and size-checked dimension lookups.

``dense_key`` numbers rows 1..n in a total order without funnelling them
through one task (a plain ``row_number()`` over an unpartitioned window
plans ``Exchange SinglePartition``):

1. the rows are written once, so that whatever made them (joins, duplicate
   removal) runs once: the sampling of the range bounds reads the stored rows.
   Rows that are a plain file scan already skip this step (``stored``), and so do
   rows that get their wide columns after the shuffle (``then``): the sampling runs their
   last stage a second time, which is less than writing and reading them;
2. they are range-partitioned and sorted by the order and written again: one
   file for each range, named in range order.  The written files also cut the
   lineage, and later readers get column pruning;
3. the rows of each file are counted (one row per file goes on), and a row's
   key is the number of rows in the files before plus its place in its own
   file, which Parquet readers know (``_metadata.row_index``): no position is
   stored with the rows.

Rows to be numbered may be restricted with ``keep``: in each file they are
sorted ahead of the others, so their places stay dense and one
materialisation also serves the rejected rows (quarantine, audit).

When the caller has *measured* the row count and it is at most
``SMALL_KEY_ROWS``, a plain ``row_number()`` over the ordered (single
partition) window is cheaper: no sampling job, no write, and a sort of at
most that many rows in one task; the one-partition result is persisted for
its consumers.  The bound is checked, never assumed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tradestar.session import WIDE_TABLE_CODEC, materialize, release

_FILE = "_ts_file"
_ROW = "_ts_row"
_KEEP = "_ts_keep"

# Largest measured row count numbered in a single task.
SMALL_KEY_ROWS = 1_000_000

# Default bounds for broadcasting a dimension lookup: rows, and the bytes that so
# many rows of its schema can take at most.
DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 << 20
# A value that this share of the rows has is joined by broadcast, not in one task.
HOT_SHARE = 0.001
# Longest text of the warehouse (VARCHAR(255)) in UTF-8.
_TEXT_BYTES = 4 * 255


_cached: list[DataFrame] = []


def taken_caches() -> list[DataFrame]:
    """The frames that :func:`dense_key` has persisted since the last call; whoever takes them unpersists them."""
    out = list(_cached)
    _cached.clear()
    return out


def _sort_cols(order: list[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in order]


def dense_key(
    df: DataFrame,
    order: list[str | Column],
    key_name: str,
    keep: Column | None = None,
    rows: int | None = None,
    small_rows: int = SMALL_KEY_ROWS,
    observe: tuple[Observation, list[Column]] | None = None,
    stored: bool = False,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``df`` plus ``key_name`` = 1..n in ``order`` (NULL for rows not kept).

    ``order`` should be a total order; ties get consecutive keys in an
    unspecified but equal-valued arrangement.  ``rows`` is a measured row
    count of ``df`` (see :func:`count_rows`), enabling the small path up to
    ``small_rows`` rows.  ``observe`` = (observation, metric columns) is
    collected while the rows are first written.  ``stored`` says that ``df`` is a scan
    of files, which is sampled and read again as it is.  ``then`` adds columns to the rows
    where they have been shuffled to, so that these are not shuffled: expressions of a row, or
    lookups joined by broadcast, which leave every row in its place.  ``keep`` and the
    metrics may use them; the rows are not written before.
    """
    if keep is None and rows is not None and rows <= small_rows:
        window = Window.orderBy(*_sort_cols(order))
        # one partition of at most small_rows rows, read by several consumers
        # (lookups, role-playing twins, writes): kept in memory, and recomputed
        # with the same keys if lost, since the order is total
        _cached.append(df.withColumn(key_name, F.row_number().over(window).cast("long")).persist())
        return _cached[-1]
    keep_expr = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))

    def judged(rows: DataFrame) -> DataFrame:
        marked = rows.withColumn(_KEEP, keep_expr)
        return marked if observe is None else marked.observe(observe[0], *observe[1])

    order_by = _sort_cols(order)
    if then is not None:
        # judged behind the shuffle: the sampling would count the rows, too
        once, ranged = None, judged(then(df.repartitionByRange(*order_by)))
    else:
        once = None if stored and observe is None else materialize(judged(df), f"unnumbered_{key_name}", WIDE_TABLE_CODEC)
        ranged = (judged(df) if once is None else once).repartitionByRange(*order_by)
    # kept rows first in every file
    written = materialize(ranged.sortWithinPartitions(F.col(_KEEP).desc(), *order_by), f"dense_key_{key_name}", WIDE_TABLE_CODEC)
    if once is not None:
        release(once)
    located = written.select("*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))

    counts = located.groupBy(_FILE).agg(F.count_if(F.col(_KEEP)).alias("_n"))
    # files are named by range; a range written as several files numbers those, too
    place = [F.regexp_extract(_FILE, r"part-(\d+)", 1).cast("long"), F.col(_FILE)]
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_FILE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row for each file
    numbered = located.join(F.broadcast(offsets), _FILE, "left").withColumn(key_name, F.when(F.col(_KEEP), F.col("_off") + F.col(_ROW) + 1).cast("long"))
    return numbered.drop(_FILE, _ROW, "_off", _KEEP)


def count_rows(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Exact row counts of several (small or materialised) frames in one job.

    One aggregate row per frame, so the driver receives ``len(frames)``
    numbers, never data.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in frames.items()]
    return {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, parts).collect()}


def most_bytes(df: DataFrame, rows: int) -> int:
    """Bytes that ``rows`` rows of the frame's columns can take at most (texts of the warehouse's lengths)."""
    return rows * sum(_TEXT_BYTES if f.dataType.typeName() == "string" else 16 for f in df.schema.fields)


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its row count is at most ``max_rows`` and its bytes within ``BROADCAST_BYTES``.

    ``rows`` is a measured upper bound of the row count (e.g. the count of
    the dimension a lookup is derived from); without it the frame is
    counted.  Above the bounds the frame is returned unchanged and the
    planner (with AQE) chooses the join, splitting skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, rows) else df


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, rows: int | None = None) -> bool:
    """Whether :func:`bounded_broadcast` broadcasts the frame."""
    n = df.count() if rows is None else rows
    return n <= max_rows and most_bytes(df, n) <= BROADCAST_BYTES


def frequent_values(df: DataFrame, column: str, share: float = HOT_SHARE) -> list:
    """Every value (but NULL) that at least ``share`` of the rows have, and perhaps others: at most ``1 / share`` in all.

    One scan of the column; a task sends as many counters at most.
    """
    return df.filter(F.col(column).isNotNull()).stat.freqItems([column], share).first()[0] or []


def lookup_frame(dim: DataFrame, natural_key: str, sk: str, alias_key: str | None = None, extra: list[str] | None = None) -> DataFrame:
    """``natural key -> sk`` with one row per key (smallest sk wins).

    A dimension whose business id repeats would otherwise multiply fact rows
    in the join; the duplicate itself is reported by the uniqueness check.
    """
    aggs = [F.min(sk).alias(sk)] + [F.min_by(F.col(c), F.col(sk)).alias(c) for c in (extra or [])]
    out = dim.groupBy(natural_key).agg(*aggs)
    if alias_key:
        out = out.withColumnRenamed(natural_key, alias_key)
    return out
