"""JDBC source and sink (extract of the nine source tables, warehouse load).

Large tables are read in parallel: ``partition_column`` with its bounds
(fetched with one pushed-down ``min/max`` query) splits the read into
``num_partitions`` range queries.  Filters and column selections applied to
the returned DataFrame are pushed into the database query by Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tradestar.schemas import OPTIONAL_TABLES, REQUIRED_TABLES
from tradestar.sources.bronze import Bronze, standardize_bronze
from tradestar.sources.writers import write_all


def quote_identifier(url: str, name: str) -> str:
    """Identifier quoted for the database behind ``url`` (MySQL: backticks)."""
    return f"`{name}`" if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else f'"{name}"'


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """One table; partitioned by ``partition_column`` when given."""
    props = dict(properties or {})
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in props.items():
        reader = reader.option(k, v)
    if partition_column and num_partitions and num_partitions > 1:
        q = quote_identifier(url, partition_column)
        bounds = (
            spark.read.format("jdbc")
            .option("url", url)
            .option("query", f"SELECT MIN({q}) AS lo, MAX({q}) AS hi FROM {table}")
            .options(**props)
            .load()
            .collect()[0]
        )
        lo, hi = bounds[0], bounds[1]
        if lo is not None:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", int(lo))
                .option("upperBound", int(hi) + 1)
                .option("numPartitions", num_partitions)
            )
    return reader.load()


def _is_missing_table(exc: Exception) -> bool:
    """SQL states of an unknown table (MySQL / ODBC, Derby, PostgreSQL), or a driver's words for it."""
    return bool(re.search(r"42S02|42X05|42P01|(table|view|relation|object)\b.*(does(n't| not) exist|not found)|no such table|unknown table", str(exc), re.I))


def read_bronze_jdbc(
    spark: SparkSession,
    url: str,
    properties: dict[str, str] | None = None,
    partitioning: dict[str, tuple[str, int]] | None = None,
    tables: list[str] | None = None,
) -> Bronze:
    """The nine source tables over JDBC (optional ones may be missing).

    ``partitioning`` maps a table to ``(column, partitions)`` for parallel
    reads of the large tables (``transacoes``, ``cambios``).
    """
    part = partitioning or {}
    frames: dict[str, DataFrame | None] = {}
    for table in tables or (REQUIRED_TABLES + OPTIONAL_TABLES):
        col, n = part.get(table, (None, None))
        try:
            df = read_jdbc_table(spark, url, table, properties, col, n)
            df.schema
            frames[table] = df
        except Exception as exc:  # each driver has its own class: only "no such table" makes a table optional
            if table in OPTIONAL_TABLES and _is_missing_table(exc):
                frames[table] = None
            else:
                raise
    # database identifiers may come back upper-cased
    frames = {t: (None if df is None else df.toDF(*[c.lower() for c in df.columns])) for t, df in frames.items()}
    return standardize_bronze(frames)


def write_jdbc_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """Bulk insert with batched statements; ``num_partitions`` caps the
    number of concurrent connections."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()


def write_star_jdbc(
    tables: dict[str, DataFrame],
    url: str,
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    fact: str = "fato_transacoes_internacionais",
) -> None:
    """Load the warehouse into a database: dimensions first (concurrently),
    then the fact, each with batched inserts.  ``overwrite`` recreates the
    tables, like dropping them and re-running the DDL before the load."""

    def write_one(name: str, df: DataFrame) -> None:
        write_jdbc_table(df, url, name, properties, mode, batch_size, num_partitions)

    write_all({n: df for n, df in tables.items() if n != fact}, write_one)
    write_all({fact: tables[fact]}, write_one)
