"""Compare every ``queries()`` result with its ``oracle_sql()`` in DuckDB.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``.  Prints one line
per key (rows, columns, value match) and exits non-zero on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v, exact_float: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if exact_float else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def spark_type_as_duckdb(t: str) -> str:
    """Spark simpleString -> DuckDB type name (for the schema comparison)."""
    simple = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "smallint": "SMALLINT",
        "tinyint": "TINYINT",
        "double": "DOUBLE",
        "float": "FLOAT",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
        "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
        "timestamp": "TIMESTAMP WITH TIME ZONE",
    }
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return simple.get(t, t.upper())


def type_mismatches(sdf, con, sql) -> list[str]:
    spark_types = {f.name: spark_type_as_duckdb(f.dataType.simpleString()) for f in sdf.schema.fields}
    duck_types = {r[0]: r[1].replace(" ", "") for r in con.execute(f"describe {sql}").fetchall()}
    return [f"{c}: spark {spark_types[c]} duckdb {duck_types.get(c)}" for c in spark_types if spark_types[c].replace(" ", "") != duck_types.get(c)]


def rows_key(rows, cols, exact_float):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i], exact_float) for i in order) for r in rows), key=lambda t: tuple((x is None, x or "") for x in t))


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return True, f"{name}: spark rows={len(srows)} (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(scols) != sorted(ocols):
        return False, f"{name}: COLUMNS differ spark={scols} oracle={ocols}"
    if len(srows) != len(orows):
        return False, f"{name}: ROWS differ spark={len(srows)} oracle={len(orows)}"
    exact = rows_key(srows, scols, True) == rows_key(orows, ocols, True)
    loose = exact or rows_key(srows, scols, False) == rows_key(orows, ocols, False)
    if not loose:
        a, b = rows_key(srows, scols, False), rows_key(orows, ocols, False)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: VALUES differ cols={sorted(scols)} first={diff}"
    tag = "exact" if exact else "float~"
    types = type_mismatches(sdf, con, sql)
    if types:
        return False, f"{name}: TYPES differ {types}"
    return True, f"{name}: ok rows={len(srows)} {tag} spark {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from tradestar.session import build_session

    spark = build_session(checkpoint_dir=tempfile.mkdtemp(prefix="ck-", dir="/tmp"))
    con = duck(sf_dir)
    oracle = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, name, fn, oracle.get(name))
        except Exception as exc:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(("  " if ok else "!!") + msg, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
