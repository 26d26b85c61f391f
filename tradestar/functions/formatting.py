"""Presentation labels of the marts (period labels, money text, cards)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Presentation formats of the BI views.
PERIOD_FORMAT = "%04d-%02d"  # year-month label
QUARTER_INFIX = "-T"  # year-quarter label: 2024-T1
CURRENCY_PREFIX = "R$ "
THOUSANDS_SEPARATOR = "."
DECIMAL_SEPARATOR = ","


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.format_string(PERIOD_FORMAT, year, month)


def quarter_label(year: Column, quarter: Column) -> Column:
    """``YYYY-Tq``."""
    return F.concat(year.cast("string"), F.lit(QUARTER_INFIX), quarter.cast("string"))


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def thousands(x: Column) -> Column:
    """Integer text with ``.`` as thousands separator: ``1.234.567``."""
    return F.translate(F.format_number(x, 0), ",", THOUSANDS_SEPARATOR)


def money_text(x: Column) -> Column:
    """``R$ 1.234.567,89`` (dot thousands, comma decimals)."""
    # format_number writes 1,234.56; swap both separators in one pass
    swapped = F.translate(F.format_number(x, 2), ",.", THOUSANDS_SEPARATOR + DECIMAL_SEPARATOR)
    return F.concat(F.lit(CURRENCY_PREFIX), swapped)


def fixed_one(x: Column) -> Column:
    """One decimal place of a double, as its exact binary value rounds (ties to even).

    Text formatting in the JVM rounds the shortest decimal form half up, which
    differs at ties (0.25) and next to them (0.15).  With w the whole part and f the
    fraction, f lies above (2n + 1) / 20 if 16 f - (2n + 1) > -4 f, both sides exact.
    """
    size = F.abs(x)
    whole = F.floor(size)
    part = size - whole
    n = F.floor(part * 10)
    left, right = part * 16 - (2 * n + 1), part * -4
    up = (left > right) | ((left == right) & (n % 2 == 1))
    tenths = whole * 10 + n + up.cast("bigint")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def rank_label(value: Column, pct: Column) -> Column:
    """``1.234 (20.6%)``."""
    return F.concat(thousands(value), F.lit(" ("), fixed_one(pct), F.lit("%)"))


def signed_pct(pct: Column) -> Column:
    """``+12.3%`` / ``-4.0%``."""
    return F.concat(F.when(pct >= 0, F.lit("+")).otherwise(F.lit("")), fixed_one(pct), F.lit("%"))
