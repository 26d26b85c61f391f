"""Text-to-value coercion with "invalid becomes NULL" semantics.

All of it is built-in Column expressions (``try_cast``), so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default set of tokens that a pandas CSV read treats as
# missing.  A bronze file written by the extraction step uses them for NULL.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def null_tokens_to_null(c: Column) -> Column:
    """NULL for a missing-value token, the text unchanged otherwise."""
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast(T.StringType())).otherwise(c)


def to_decimal(c: Column, dtype: T.DecimalType) -> Column:
    """Number from text, NULL when not a finite number.

    ``NaN``, ``inf``, ``1,5``, ``1_0`` and ``abc`` give NULL; surrounding
    blanks are ignored.  Values with more decimals than ``dtype`` are rounded.
    """
    return F.trim(c.cast(T.StringType())).try_cast(dtype)


# Fixed value: the plain numeric literal a dataframe CSV reader accepts
# (sign, digits with an optional point, optional exponent).
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def is_positive_number(c: Column) -> Column:
    """True when the text is a finite number greater than zero (never NULL).

    The sign is read from the double value, so a value with more decimals
    than its staging type (``0.00001``) or beyond any decimal type
    (``1E100``, quarantined later as out of range) is still judged right;
    the pattern rejects what only the JVM parser accepts (``1d``, ``0x1p3``).
    """
    text = F.trim(c.cast(T.StringType()))
    d = text.try_cast(T.DoubleType())
    ok = text.rlike(NUMBER_PATTERN) & (d > 0) & (d < F.lit(float("inf")))
    return F.coalesce(ok, F.lit(False))


def to_integer(c: Column, dtype: T.DataType = T.LongType()) -> Column:
    """Integer from text or number; ``"1.0"`` is 1, ``"1.5"`` and junk are NULL.

    A column with missing values comes out of a dataframe extract as
    ``1.0``-style floats, so integral decimals are accepted.
    """
    d = to_decimal(c, T.DecimalType(38, 6))
    return F.when(d == F.floor(d), d.try_cast(dtype))


def to_timestamp_ntz(c: Column, formats: list[str] | None = None) -> Column:
    """Timestamp without zone from an ISO date or date-time, else from the
    first of ``formats`` (Spark datetime patterns, e.g. ``"dd/MM/yyyy"``)
    that parses it, NULL otherwise.  Decided per value, never per file."""
    text = F.trim(c.cast(T.StringType()))
    parsed = [text.try_cast(T.TimestampNTZType())]
    parsed += [F.try_to_timestamp(text, F.lit(f)).try_cast(T.TimestampNTZType()) for f in formats or []]
    return F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]


def round_to_int(c: Column) -> Column:
    """Half-up rounding to INT (a bare cast would truncate 2.5 to 2)."""
    return F.round(c, 0).try_cast(T.IntegerType())
