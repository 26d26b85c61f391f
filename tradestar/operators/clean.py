"""Cleaning of the two transactional bronze tables.

Transactions: exact duplicates removed, rows with a missing required field
dropped, value and quantity coerced (invalid becomes missing) and kept only
when positive.  FX rates: date and rate coerced, invalid or non-positive
rows dropped, then the first *valid* row per id is kept (filter before
keep-first).

Both deduplications are aggregations, so Spark combines map-side before the
shuffle: a row copied a billion times, or a hot FX id, collapses to one row
per task before it leaves the executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.functions.coerce import is_positive_number, to_decimal, to_timestamp_ntz
from tradestar.schemas import BRONZE_COLUMNS, QTY_STAGE, RATE_STAGE, VALUE_STAGE

TRANSACTION_COLUMNS = BRONZE_COLUMNS["transacoes"]
FX_ORDER = ["data", "taxa_cambio", "moeda_origem", "moeda_destino"]


def valid_transactions(t: DataFrame) -> DataFrame:
    """Rows with all nine fields present and a positive value and quantity.

    Raw text is kept; :func:`clean_transacoes` judges duplicates by value.
    """
    present = F.lit(True)
    for c in TRANSACTION_COLUMNS:
        present = present & F.col(c).isNotNull()
    # positivity is judged on the exact text (a wide scale), so a value with
    # more decimals than its staging type is not rounded away before the test
    positive = is_positive_number(F.col("valor_monetario")) & is_positive_number(F.col("quantidade"))
    return t.select(*TRANSACTION_COLUMNS).filter(present & positive)


def by_value(c: Column) -> Column:
    """One spelling for every positive number, however long: its digits without zeros at either end, ``e``, the power of ten.

    Works on the text alone (``1e2``, ``+100.0`` and ``0.1E+3`` are ``1e2``), so no width of a
    decimal type limits it and nothing is rounded.  The text is a plain numeric literal
    (see :func:`is_positive_number`); ``try_cast`` reads the spelling as a number again.
    """
    text = F.upper(F.trim(c))
    mantissa = F.ltrim(F.substring_index(text, "E", 1), F.lit("+"))
    # the cast is costly where it fails: only texts with an exponent get there
    power = F.when(text.contains("E"), F.substring_index(text, "E", -1).try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    decimals = F.when(mantissa.contains("."), F.length(F.substring_index(mantissa, ".", -1))).otherwise(0)
    digits = F.ltrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0"))
    bare = F.rtrim(digits, F.lit("0"))
    return F.concat(bare, F.lit("e"), (power - decimals + F.length(digits) - F.length(bare)).cast("string"))


def clean_transacoes(t: DataFrame, near: str | None = None) -> DataFrame:
    """Cleaned transactions with ``valor_monetario decimal(19,4)`` and
    ``quantidade decimal(20,4)``.

    The validity filter is a per-row predicate, so running it before the
    duplicate removal gives the same rows and shuffles less.  Numbers are
    compared by value (``100.0`` and ``100.00`` are one), at any length and power.

    With ``near`` the rows are shuffled by that column alone, so a join by it needs no shuffle
    of them again.  Copies are then not combined map-side and a value is one task's, so
    frequent values have to be cleaned without it.
    """
    exact = {c: by_value(F.col(c)) for c in ("valor_monetario", "quantidade")}
    spelled = valid_transactions(t).withColumns(exact)
    deduped = (spelled.repartition(near) if near else spelled).dropDuplicates()
    return deduped.select(
        "id",
        "tipo_id",
        "pais_origem",
        "pais_destino",
        "produto_id",
        to_decimal(F.col("valor_monetario"), VALUE_STAGE).alias("valor_monetario"),
        to_decimal(F.col("quantidade"), QTY_STAGE).alias("quantidade"),
        "transporte_id",
        "cambio_id",
    )


def valid_cambios(c: DataFrame, date_formats: list[str] | None = None) -> DataFrame:
    """FX rows with a parsable date and a positive rate (typed).

    Dates are ISO dates or date-times; ``date_formats`` adds patterns tried
    in order for other spellings (e.g. ``["dd/MM/yyyy"]``).
    """
    date = to_timestamp_ntz(F.col("data"), date_formats)
    ok = date.isNotNull() & is_positive_number(F.col("taxa_cambio"))
    return c.filter(ok).select(
        "id",
        date.alias("data"),
        "moeda_origem",
        "moeda_destino",
        to_decimal(F.col("taxa_cambio"), RATE_STAGE).alias("taxa_cambio"),
    )


def clean_cambios(c: DataFrame, date_formats: list[str] | None = None) -> DataFrame:
    """One valid FX row per id: the first by (date, rate, currencies).

    The source order of the rows is not defined, so "first" is the minimum
    of that tuple; the min is a partial aggregate (combined map-side).
    """
    first = valid_cambios(c, date_formats).groupBy("id").agg(F.min(F.struct(*FX_ORDER)).alias("_first"))
    return first.select("id", "_first.data", "_first.moeda_origem", "_first.moeda_destino", "_first.taxa_cambio")
