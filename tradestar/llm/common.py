"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: White space between words: space and the ASCII controls 9 to 13 (as an RE2 / Java class body).
SPACES = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def bytes_of(column) -> list:
    """UTF-8 bytes of an Arrow string column (None for null), without decoding it."""
    import pyarrow as pa

    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (names compare as Spark compares them)."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def space_words(text: Column) -> Column:
    """Words between runs of ASCII white space, as an array (null text: empty)."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return let(bare, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{SPACES}]+")))


def numbered(df: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns named ``in_0``, ``in_1``, ..., whatever their names hold, and the names that the ``wanted`` ones have there."""
    names = {c: f"in_{i}" for i, c in enumerate(df.columns)}
    lower = {c.lower(): n for c, n in names.items()}
    return df.toDF(*names.values()), [names.get(w) or lower[w.lower()] for w in wanted]
