"""Incremental load into existing tables: insert only new keys.

``insert_ignore`` is the batch operator: the incoming rows are deduplicated
on the primary key (keep-first over a total order, a partial aggregate) and
stored; rows whose key already exists in the target are removed (a batch of
measured small size is broadcast against the target's key column, so the
target is never shuffled; a large batch uses a plain anti join); the
remainder is materialised as a table next to the checkpoints (so the target
is never read while it is being written, and a lost executor does not
recompute against a target that already changed) and appended.  Running it twice with the same input appends
nothing the second time.  Of a target of many files only those are read whose range of keys
meets the batch's (:func:`files_with_keys`).

``stream_insert_ignore`` runs the same operator over a folder of arriving
CSV files with Structured Streaming (``trigger(availableNow=True)`` +
``foreachBatch``): each micro-batch is an insert-ignore, and the stream's
checkpoint records which files were consumed.  A replayed batch is harmless
because the anti join makes the operator idempotent.

Single writer per target is assumed: plain Parquet has no atomic
read-check-append across concurrent writers.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.operators.keys import DEFAULT_BROADCAST_ROWS
from tradestar.schemas import BRONZE_COLUMNS, raw_schema
from tradestar.session import ensure_checkpoint_dir, materialize, path_exists, release
from tradestar.sources.bronze import CSV_QUOTING, is_missing_path, null_tokens_to_null, read_csv_table, standardize_table


#: A target of more files than this has the range of keys of each file looked up first.
SCANNED_FILES = 8
#: Ranges that the keys of a batch are summed up in.
BATCH_RANGES = 64
_KEY_RANGES = "_key_ranges"


def _read_target(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    try:
        df = spark.read.format(fmt).load(path)
        df.schema
        return df
    except AnalysisException as exc:
        # a folder that exists but holds no file yet is an empty target too
        if is_missing_path(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def _plain(path: str) -> str:
    """A file's name as listings and metadata agree on it."""
    return re.sub(r"^file:/+", "/", path)


def files_with_keys(spark: SparkSession, target_path: str, key: str, batch: DataFrame) -> list[str]:
    """Files of a Parquet target that may hold a ``key`` of ``batch``.

    A small table in the target's folder (hidden from its readers) has the smallest and
    largest key of each file.  Files that it does not know yet, from whichever writer,
    are read once, their key column only, and added.  The batch's keys are summed up in at most
    ``BATCH_RANGES`` ranges; a file whose range meets none of them is not read.
    """
    index_path = f"{target_path.rstrip('/')}/{_KEY_RANGES}/{key}"
    target = spark.read.parquet(target_path)
    files = {_plain(f): f for f in target.inputFiles()}
    empty = spark.createDataFrame([], T.StructType([T.StructField("file", T.StringType()), T.StructField("low", target.schema[key].dataType), T.StructField("high", target.schema[key].dataType)]))
    index = spark.read.parquet(index_path) if path_exists(spark, index_path) else empty
    known = {r.file for r in index.select("file").collect()}
    missing = [f for name, f in files.items() if name not in known]
    if missing:
        # a file without keys has null bounds, and is known from then on
        found = spark.read.schema(target.schema).parquet(*[unquote(f) for f in missing]).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        found.select(F.regexp_replace("path", "^file:/+", "/").alias("file"), "low", "high").coalesce(1).write.mode("append").parquet(index_path)
        index = spark.read.parquet(index_path)
    ranges = batch.select(key).repartitionByRange(BATCH_RANGES, key).groupBy(F.spark_partition_id()).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    meets = F.lit(False)
    for r in ranges:
        meets = meets | ((F.col("low") <= F.lit(r.high)) & (F.col("high") >= F.lit(r.low)))
    return sorted({files[r.file] for r in index.filter(meets).select("file").collect() if r.file in files})


def dedup_on_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest by the remaining columns (in order)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def new_rows(
    incoming: DataFrame, target: DataFrame | None, keys: list[str], incoming_rows: int | None = None
) -> DataFrame:
    """Incoming rows whose key is not in the target; ``incoming`` has one row
    per key already (see :func:`dedup_on_keys`).

    With a measured incoming size within the broadcast bound, the target's
    key columns are streamed past a broadcast of the incoming keys (left
    semi join: the target is scanned, column-pruned, never shuffled) to find
    the keys that already exist, and only those small sets meet in the anti
    join.  Otherwise a plain anti join against the target's keys.
    """
    if target is None:
        return incoming
    if incoming_rows is not None and incoming_rows <= DEFAULT_BROADCAST_ROWS:
        # distinct: a target that repeats keys must not make the broadcast larger than the batch
        existing = target.select(*keys).join(F.broadcast(incoming.select(*keys)), keys, "left_semi").distinct()
        return incoming.join(F.broadcast(existing), keys, "left_anti")
    return incoming.join(target.select(*keys), keys, "left_anti")


def insert_ignore(
    spark: SparkSession,
    incoming: DataFrame,
    target_path: str,
    keys: list[str],
    fmt: str = "parquet",
    rejects: list[DataFrame] | None = None,
) -> DataFrame:
    """Append the new rows of ``incoming`` to the table at ``target_path``.

    Returns the appended rows (materialised).  A primary key is never NULL: rows
    with a NULL in a key column are not loaded; they are appended as one frame to
    ``rejects``, if given.
    """
    ensure_checkpoint_dir(spark)
    target = _read_target(spark, target_path, fmt)
    if target is not None:
        incoming = incoming.select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns])
    # one row per key, stored: its size is then known (Parquet metadata) and
    # it is read twice below without recomputing the batch
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    if rejects is not None:
        rejects.append(incoming.filter(~keyed))
    deduped = materialize(dedup_on_keys(incoming.filter(keyed), keys), "insert_ignore_batch")
    if target is not None and fmt == "parquet" and len(target.inputFiles()) > SCANNED_FILES:
        files = files_with_keys(spark, target_path, keys[0], deduped)
        target = spark.read.schema(target.schema).parquet(*map(unquote, files)) if files else None
    delta = materialize(new_rows(deduped, target, keys, deduped.count()), "insert_ignore_delta")
    delta.write.mode("append").format(fmt).save(target_path)
    release(deduped)
    return delta


def load_incremental(
    spark: SparkSession,
    csv_dir: str,
    target_dir: str,
    tables: list[str] | None = None,
    header: bool = True,
    mode: str = "insert-ignore",
) -> dict[str, DataFrame]:
    """Insert-ignore every chosen bronze CSV into ``<target_dir>/<table>``.

    ``tables`` restricts the load (e.g. ``["cambios", "transacoes"]``);
    ``csv_dir`` may point at any folder of bronze-shaped CSV files.  The
    primary key of every source table is ``id``.
    """
    if mode != "insert-ignore":
        raise ValueError(f"unsupported mode: {mode}")
    out = {}
    for table in tables or list(BRONZE_COLUMNS):
        df = read_csv_table(spark, f"{csv_dir.rstrip('/')}/{table}.csv", table, header=header)
        out[table] = insert_ignore(spark, standardize_table(table, df), f"{target_dir.rstrip('/')}/{table}", ["id"])
    return out


def stream_insert_ignore(
    spark: SparkSession,
    source_dir: str,
    table: str,
    target_path: str,
    checkpoint_location: str,
    header: bool = False,
    processing_time: str | None = None,
):
    """Consume the CSV files of ``source_dir`` (one bronze table) as a stream
    and insert-ignore each micro-batch into ``target_path``.

    By default every file present now is processed and the call returns
    (``availableNow``).  With ``processing_time`` (e.g. ``"1 minute"``) the
    query keeps running, picking up new files each interval, and is returned
    to the caller to stop.
    """
    stream = spark.readStream.schema(raw_schema(table)).options(**CSV_QUOTING).option("header", header).csv(source_dir)
    stream = standardize_table(table, stream.select(*[null_tokens_to_null(F.col(c)).alias(c) for c in stream.columns]))

    def _batch(df: DataFrame, _epoch: int) -> None:
        release(insert_ignore(df.sparkSession, df, target_path, ["id"]))

    writer = stream.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint_location)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
