"""Integrity checks declared by the warehouse model, run as Spark jobs.

Every check returns ``(table_name, check_name, violations)``; a zero
violation count means the constraint holds.  The counters of a table (NOT
NULL, text length) are one aggregate over one scan, unpivoted with ``stack``,
and so is the decimal range, which reads the staged rows: a stored value has
its type already, and what did not fit is in quarantine.  Each unique key is an aggregate over its own column, and the
foreign keys take one more fact scan.  The foreign-key check reads the fact
once for all nine keys and aggregates by key value first (partial
aggregation), so only distinct key values meet the dimensions in the anti
join, whatever the dimension size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.schemas import DIMENSION_BUSINESS_KEYS, FACT, FACT_FOREIGN_KEYS, MONEY, RATE, VARCHAR_LIMITS, WAREHOUSE


def _rows(table: str, counts: dict[str, Column], df: DataFrame) -> DataFrame:
    """One aggregate over ``df`` producing one output row per named count."""
    if not counts:
        return None
    names = list(counts)
    agg = df.agg(*[c.cast("bigint").alias(f"_c{i}") for i, c in enumerate(counts.values())])
    stack = ", ".join(f"'{n}', _c{i}" for i, n in enumerate(names))
    return agg.selectExpr(f"'{table}' as table_name", f"stack({len(names)}, {stack}) as (check_name, violations)")


def _union(frames: list[DataFrame | None]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f for f in frames if f is not None])


FAMILIES = ("unique", "not_null", "lengths")


def _table_counts(name: str, families: tuple[str, ...]) -> dict[str, Column]:
    """Named violation counts of one table for the chosen check families."""
    schema = WAREHOUSE[name]
    counts: dict[str, Column] = {}
    if "not_null" in families:
        for f in schema.fields:
            if not f.nullable:
                counts[f"not_null:{f.name}"] = F.count(F.lit(1)) - F.count(F.col(f.name))
    if "lengths" in families:
        for c, n in VARCHAR_LIMITS.get(name, {}).items():
            counts[f"length:{c}<={n}"] = F.count_if(F.length(F.col(c)) > n)
    return counts


def _unique(name: str, df: DataFrame) -> list[DataFrame]:
    """Repeated non-NULL keys (a NULL key is reported by the NOT NULL check).

    Each key has an aggregate of its own, so that nothing but the key column is
    shuffled by it.
    """
    keys = [("pk", WAREHOUSE[name].fields[0].name)]
    if name in DIMENSION_BUSINESS_KEYS:
        keys.append(("business_key", DIMENSION_BUSINESS_KEYS[name]))
    return [_rows(name, {f"{label}:{key}": F.count(F.col(key)) - F.count_distinct(F.col(key))}, df.select(key)) for label, key in keys]


def _checks(tables: dict[str, DataFrame], families: tuple[str, ...]) -> DataFrame:
    """One aggregate (one scan, no shuffle of rows) per table for the counters, one per key for uniqueness."""
    found = [_rows(name, _table_counts(name, families), df) for name, df in tables.items()]
    if "unique" in families:
        found += [u for name, df in tables.items() for u in _unique(name, df)]
    return _union(found)


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Primary key of all ten tables; business id of every dimension."""
    return _checks(tables, ("unique",))


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    return _checks(tables, ("not_null",))


def check_lengths(tables: dict[str, DataFrame]) -> DataFrame:
    return _checks({n: t for n, t in tables.items() if n in VARCHAR_LIMITS}, ("lengths",))


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan fact rows per foreign key, in one scan of the fact.

    The nine keys are unpivoted to ``(fk, value)`` and aggregated (partial
    aggregation: at most one row per distinct key value and task is
    shuffled), then one anti join against the union of all dimension keys.
    """
    fact = tables[FACT]
    names = list(FACT_FOREIGN_KEYS)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("fk"), F.col(c).cast("long").alias("v")) for c in names]))
    per_key = (
        fact.select(pairs.alias("p"))
        .select("p.fk", "p.v")
        .filter(F.col("v").isNotNull())
        .groupBy("fk", "v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    known = reduce(
        DataFrame.unionByName,
        [tables[dim].select(F.lit(col).alias("fk"), F.col(col).cast("long").alias("v")) for col, dim in FACT_FOREIGN_KEYS.items()],
    )
    orphans = per_key.join(known, ["fk", "v"], "left_anti")
    counts = {
        f"fk:{col}->{dim}": F.coalesce(F.sum(F.when(F.col("fk") == col, F.col("_c"))), F.lit(0))
        for col, dim in FACT_FOREIGN_KEYS.items()
    }
    return _rows(FACT, counts, orphans)


def check_ranges(staged: DataFrame) -> DataFrame:
    """Staged values (unrounded, kept rows or not) that do not fit their stored decimal.

    Cleaning keeps positive numbers only, so a value that is NULL here, or the
    rate of an FX row that was found, was too large for the staging decimal.
    A converted value is judged where both of its factors are known.
    """

    def outside(c: Column, dtype) -> Column:
        return c.isNotNull() & c.try_cast(dtype).isNull()

    value, converted, rate = F.col("valor_monetario_transacao"), F.col("valor_convertido"), F.col("taxa_cambio")
    found = {
        "valor_monetario_transacao": value.isNull() | outside(value, MONEY),
        "valor_convertido_transacao": outside(converted, MONEY),
        "custo_transporte_transacao": outside(F.lit(0), MONEY),  # a constant of the model
        "taxa_cambio_transacao": (F.col("data").isNotNull() & rate.isNull()) | outside(rate, RATE),
    }
    return _rows(FACT, {f"range:{c}": F.count_if(bad) for c, bad in found.items()}, staged)


def run_all(tables: dict[str, DataFrame], staged: DataFrame | None = None) -> DataFrame:
    """All checks: one scan per table for uniqueness, NOT NULL and lengths
    together, the single-scan foreign-key check and, with the ``staged`` rows
    of a build, the ranges."""
    return _union([_checks(tables, FAMILIES), check_foreign_keys(tables), None if staged is None else check_ranges(staged)])
