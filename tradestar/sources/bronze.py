"""The bronze layer: nine source tables, read from CSV, Parquet or JDBC.

Every reader returns the same :class:`Bronze` bundle: integer ids coerced to
``bigint`` (``"1.0"`` accepted), every other column kept as text for the
cleaning step.  ``produtos`` and ``categoria_produtos`` are optional.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.coerce import null_tokens_to_null, to_integer
from tradestar.schemas import BRONZE_COLUMNS, BRONZE_INT_COLUMNS, OPTIONAL_TABLES, REQUIRED_TABLES, raw_schema
from tradestar.sources.writers import parquet_writer, write_all


@dataclass
class Bronze:
    transacoes: DataFrame
    paises: DataFrame
    moedas: DataFrame
    cambios: DataFrame
    tipos_transacoes: DataFrame
    transportes: DataFrame
    blocos_economicos: DataFrame
    produtos: DataFrame | None = None
    categoria_produtos: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame | None]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def standardize_table(table: str, df: DataFrame) -> DataFrame:
    """Known columns in fixed order; ids as bigint, the rest as text.

    Columns missing from the input (optional product columns) become NULL.
    """
    present = set(df.columns)
    int_cols = set(BRONZE_INT_COLUMNS[table])
    out = []
    for name in BRONZE_COLUMNS[table]:
        if name not in present:
            target = T.LongType() if name in int_cols else T.StringType()
            out.append(F.lit(None).cast(target).alias(name))
            continue
        c = F.col(name)
        dtype = df.schema[name].dataType
        if name in int_cols:
            if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
                out.append(c.cast(T.LongType()).alias(name))
            else:
                out.append(to_integer(c).alias(name))
        elif isinstance(dtype, T.StringType):
            out.append(c.alias(name))
        else:
            out.append(c.cast(T.StringType()).alias(name))
    return df.select(*out)


def standardize_bronze(frames: dict[str, DataFrame | None]) -> Bronze:
    missing = [t for t in REQUIRED_TABLES if frames.get(t) is None]
    if missing:
        raise ValueError(f"required bronze tables missing: {missing}")
    return Bronze(**{t: (None if frames.get(t) is None else standardize_table(t, frames[t])) for t in REQUIRED_TABLES + OPTIONAL_TABLES})


def is_missing_path(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    name = cond() if callable(cond) else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(exc)


#: A quote inside a quoted field is doubled.
CSV_QUOTING = {"quote": '"', "escape": '"'}


_CORRUPT = "_corrupt_record"


def _files_with_open_quotes(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files that hold a line with an odd number of quotes, all files that hold a line).

    Only there can a quoted field go on in the next line.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2 == 1).alias("odd"))
    # one row for each file
    found = lines.groupBy("file").agg(F.bool_or("odd").alias("odd")).collect()
    return [unquote(r.file) for r in found if r.odd], [unquote(r.file) for r in found]


def _read_csv(spark: SparkSession, paths: str | list[str], table: str, header: bool, multi_line: bool, rejects: list[DataFrame] | None) -> DataFrame:
    reader = spark.read.options(**CSV_QUOTING).option("mode", "PERMISSIVE").option("encoding", "UTF-8").option("multiLine", multi_line)
    if header:
        df = reader.option("header", True).option("inferSchema", False).csv(paths)
        names = [c.lstrip("﻿").strip() for c in df.columns]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in df.columns])
    else:
        schema = raw_schema(table)
        df, names = reader.schema(schema).csv(paths), list(schema.names)
    if rejects is not None:
        # Spark marks a record whose fields are more or fewer than the columns, or whose quotes stay
        # open, if it parses all of them, whichever columns are asked for
        marked = reader.option("header", header).option("columnPruning", False).option("columnNameOfCorruptRecord", _CORRUPT).schema(T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])).csv(paths)
        whole = marked.toDF(*names, _CORRUPT)
        # a plain null test would be pushed into the parser, where the mark is not set yet, and a
        # query must read more than the mark: the first field decides nothing here
        bad = F.coalesce(F.length(_CORRUPT), -1 - F.coalesce(F.length(names[0]), F.lit(0))) >= 0
        rejects.append(whole.filter(bad).select(F.lit(table).alias("table"), F.col(names[0]).alias("first_field"), F.col(_CORRUPT).alias("record")))
        return whole.filter(~bad).drop(_CORRUPT)
    return df.toDF(*names)


def read_csv_table(
    spark: SparkSession, path: str, table: str, header: bool = True, multi_line: bool | None = None, rejects: list[DataFrame] | None = None
) -> DataFrame:
    """One bronze CSV file or folder of files (UTF-8, a BOM is tolerated).

    A quoted field may span lines.  A file read that way is read by one task, so by
    default (``None``) one scan of the lines finds the files that have an open quote at the end of
    a line, and only those are; the others stay splittable.  True or False says it for
    all files and saves that scan.

    With a header the file's own column names are used, so columns may come
    in any order and optional ones may be absent; without a header the fixed
    column order of the table applies.  Missing-value tokens become NULL.

    With ``rejects``, malformed records (more or fewer fields than columns) are not loaded: a
    frame (table, first_field, record) of them is appended there.  Without, missing
    fields are NULL and surplus ones are left out.
    """
    if multi_line is None:
        odd, files = _files_with_open_quotes(spark, path)
        rest = [f for f in files if f not in set(odd)]
        if odd and rest:
            parts = [_read_csv(spark, p, table, header, m, rejects) for p, m in ((rest, False), (odd, True))]
            df = parts[0].unionByName(parts[1], allowMissingColumns=True)
        else:
            df = _read_csv(spark, path, table, header, bool(odd), rejects)
    else:
        df = _read_csv(spark, path, table, header, multi_line, rejects)
    return df.select(*[null_tokens_to_null(F.col(c)).alias(c) for c in df.columns])


def read_bronze_csv(
    spark: SparkSession,
    csv_dir: str,
    tables: list[str] | None = None,
    header: bool = True,
    multi_line: bool | None = None,
    rejects: list[DataFrame] | None = None,
) -> Bronze:
    """Read ``<csv_dir>/<table>.csv`` for the nine tables.

    An optional table whose file does not exist is ``None``; a missing
    required file raises, as does leaving a required table out of ``tables``.
    ``multi_line`` and ``rejects`` as in :func:`read_csv_table`.
    """
    frames: dict[str, DataFrame | None] = {}
    for table in tables or (REQUIRED_TABLES + OPTIONAL_TABLES):
        path = f"{csv_dir.rstrip('/')}/{table}.csv"
        try:
            df = read_csv_table(spark, path, table, header=header, multi_line=multi_line, rejects=rejects)
            df.schema  # resolve now so a missing file surfaces here
            frames[table] = df
        except AnalysisException as exc:
            if table in OPTIONAL_TABLES and is_missing_path(exc):
                frames[table] = None
            else:
                raise
    return standardize_bronze(frames)


def read_bronze_parquet(spark: SparkSession, bronze_dir: str) -> Bronze:
    frames: dict[str, DataFrame | None] = {}
    for table in REQUIRED_TABLES + OPTIONAL_TABLES:
        path = f"{bronze_dir.rstrip('/')}/{table}"
        try:
            df = spark.read.parquet(path)
            df.schema
            frames[table] = df
        except AnalysisException as exc:
            if table in OPTIONAL_TABLES and is_missing_path(exc):
                frames[table] = None
            else:
                raise
    return standardize_bronze(frames)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; a field that needs it is quoted, quotes inside are doubled."""
    df.write.mode(mode).options(**CSV_QUOTING).option("header", True).csv(path)


def write_bronze(bronze: Bronze, out_dir: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Bronze sink: one folder per table (written concurrently), CSV with
    header or Parquet.  A CSV folder is named like the file, so
    ``read_bronze_csv`` finds it."""
    frames = {t: df for t, df in bronze.tables().items() if df is not None}
    base = out_dir.rstrip("/")
    if fmt == "csv":
        write_all(frames, lambda t, df: write_csv(df, f"{base}/{t}.csv", mode))
    else:
        write_all(frames, parquet_writer(lambda t: f"{base}/{t}", mode))
