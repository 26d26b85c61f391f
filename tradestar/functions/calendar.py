"""Calendar attributes of the time dimension, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names (1..12) and weekday names (Monday = 0 .. Sunday = 6)
# used by the time dimension, and the label for anything else.
MONTH_NAMES = [
    "JANEIRO",
    "FEVEREIRO",
    "MARCO",
    "ABRIL",
    "MAIO",
    "JUNHO",
    "JULHO",
    "AGOSTO",
    "SETEMBRO",
    "OUTUBRO",
    "NOVEMBRO",
    "DEZEMBRO",
]
WEEKDAY_NAMES = [
    "SEGUNDA-FEIRA",
    "TERCA-FEIRA",
    "QUARTA-FEIRA",
    "QUINTA-FEIRA",
    "SEXTA-FEIRA",
    "SABADO",
    "DOMINGO",
]
UNKNOWN_NAME = "DESCONHECIDO"


def _name_lookup(names: list[str], index: Column) -> Column:
    """``names[index]`` (0-based) or the unknown label."""
    arr = F.array(*[F.lit(n) for n in names])
    return F.coalesce(F.try_element_at(arr, (index + 1).cast("int")), F.lit(UNKNOWN_NAME))


def month_name(month: Column) -> Column:
    return _name_lookup(MONTH_NAMES, month - 1)


def weekday_name(ts: Column) -> Column:
    """Name of the weekday; ``weekday`` is 0 for Monday."""
    return _name_lookup(WEEKDAY_NAMES, F.weekday(ts))


def semester(month: Column) -> Column:
    return (F.floor((month - 1) / 6) + 1).cast("int")


def time_attributes(ts: Column) -> dict[str, Column]:
    """Columns of the time dimension derived from one timestamp."""
    m = F.month(ts)
    return {
        "data_referencia": F.to_date(ts),
        "ano": F.year(ts).cast("int"),
        "mes": m.cast("int"),
        "dia": F.dayofmonth(ts).cast("int"),
        "trimestre": F.quarter(ts).cast("int"),
        "semestre": semester(m),
        "nome_do_mes": month_name(m),
        "dia_da_semana": weekday_name(ts),
    }
