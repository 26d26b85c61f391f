"""Command line: ``python -m tradestar <command> ...``.

  extract      source database (JDBC) -> bronze files (Parquet or CSV with header)
  run          build, then show BI views (the whole pipeline in one job)
  build        bronze (CSV folder, Parquet folder, JDBC or test tables) -> warehouse
  views        print the result frames of BI views 1-6 from a warehouse
  check        run the integrity checks on a warehouse
  incremental  insert-ignore bronze CSV files into source tables

The checkpoint folder comes from ``spark.checkpoint.dir`` (``--conf``).
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def _session(args) -> SparkSession:
    builder = SparkSession.builder.appName("tradestar")
    if args.master:
        builder = builder.master(args.master)
    for kv in args.conf or []:
        k, v = kv.split("=", 1)
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    from tradestar.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return spark


def _bronze(spark, args):
    from tradestar.sources import bronze as B

    if args.bronze_csv:
        rejects = [] if args.rejects else None
        multi_line = {"auto": None, "on": True, "off": False}[args.multi_line]
        bronze = B.read_bronze_csv(spark, args.bronze_csv, header=not args.no_header, multi_line=multi_line, rejects=rejects)
        if rejects:
            reduce(DataFrame.unionByName, rejects).write.mode("overwrite").json(args.rejects)
        return bronze
    if args.bronze_parquet:
        return B.read_bronze_parquet(spark, args.bronze_parquet)
    if args.jdbc_url:
        from tradestar.sources.jdbc import read_bronze_jdbc

        props = {k: v for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password)) if v}
        parts = {t: ("id", args.jdbc_partitions) for t in ("transacoes", "cambios")} if args.jdbc_partitions else None
        return read_bronze_jdbc(spark, args.jdbc_url, props, parts)
    if args.test_tables:
        from tradestar.sources.fixture import fixture_bronze

        return fixture_bronze(spark, args.test_tables)
    raise SystemExit("give --bronze-csv, --bronze-parquet, --jdbc-url or --test-tables")


def _source_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--bronze-csv")
    p.add_argument("--bronze-parquet")
    p.add_argument("--no-header", action="store_true")
    p.add_argument("--multi-line", choices=["auto", "on", "off"], default="auto", help="quoted CSV fields that span lines: found by a scan, or said")
    p.add_argument("--rejects", help="folder for malformed CSV records, which are then not loaded")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-partitions", type=int)
    p.add_argument("--test-tables")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--warehouse-jdbc-url", help="also load the ten tables into this database")
    p.add_argument("--warehouse-database", help="also register the tables in this catalog database")
    p.add_argument("--audit", action="store_true", help="print the discard counts")
    p.add_argument("--date-format", action="append", help="extra FX date pattern, e.g. dd/MM/yyyy")
    p.add_argument("--unknown-member", action="store_true", help="keep facts of products without a known category under an id-0 category")
    p.add_argument("--max-broadcast-rows", type=int, help="largest measured dimension / FX table broadcast")
    p.add_argument("--small-key-rows", type=int, help="largest measured dimension numbered in one task")


def _show_views(wh, views, rows: int) -> None:
    from tradestar.plans import marts as M

    for n in views or range(1, 7):
        for name, df in M.view(wh, n).items():
            print(f"== view {n}: {M.VIEWS[n]} / {name}")
            df.show(rows, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tradestar")
    p.add_argument("--master")
    p.add_argument("--conf", action="append", help="key=value Spark setting")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build")
    r = sub.add_parser("run")
    for cmd in (b, r):
        _source_args(cmd)
    r.add_argument("--view", type=int, choices=range(1, 7), action="append")
    r.add_argument("--rows", type=int, default=20)

    e = sub.add_parser("extract")
    e.add_argument("--jdbc-url", required=True)
    e.add_argument("--jdbc-user")
    e.add_argument("--jdbc-password")
    e.add_argument("--jdbc-partitions", type=int)
    e.add_argument("--bronze-out", required=True)
    e.add_argument("--format", choices=["parquet", "csv"], default="parquet")

    v = sub.add_parser("views")
    v.add_argument("--warehouse", required=True)
    v.add_argument("--view", type=int, choices=range(1, 7), action="append")
    v.add_argument("--rows", type=int, default=20)

    c = sub.add_parser("check")
    c.add_argument("--warehouse", required=True)

    i = sub.add_parser("incremental")
    i.add_argument("--csv-dir", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--tables", nargs="*")
    i.add_argument("--mode", default="insert-ignore", choices=["insert-ignore"])
    i.add_argument("--no-header", action="store_true")

    args = p.parse_args(argv)
    spark = _session(args)
    from tradestar.plans.star import build_star, read_star, write_star

    if args.cmd == "extract":
        from tradestar.sources.bronze import write_bronze

        args.bronze_csv = args.bronze_parquet = args.test_tables = None
        write_bronze(_bronze(spark, args), args.bronze_out, fmt=args.format)
    elif args.cmd in ("build", "run"):
        sizes = {k: v for k, v in (("max_broadcast_rows", args.max_broadcast_rows), ("small_key_rows", args.small_key_rows)) if v is not None}
        star = build_star(spark, _bronze(spark, args), date_formats=args.date_format, unknown_member=args.unknown_member, **sizes)
        write_star(star, args.warehouse, database=args.warehouse_database)
        if args.warehouse_jdbc_url:
            from tradestar.sources.jdbc import write_star_jdbc

            props = {k: v for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password)) if v}
            write_star_jdbc(read_star(spark, args.warehouse).tables(), args.warehouse_jdbc_url, props)
        if args.audit:
            print({k: v for k, v in (star.audit_metrics or {}).items() if v})
        if args.cmd == "run":
            _show_views(read_star(spark, args.warehouse), args.view, args.rows)
    elif args.cmd == "views":
        _show_views(read_star(spark, args.warehouse), args.view, args.rows)
    elif args.cmd == "check":
        from tradestar.operators.quality import run_all

        wh = read_star(spark, args.warehouse)
        run_all(wh.tables()).filter("violations <> 0").show(200, truncate=False)
    elif args.cmd == "incremental":
        from tradestar.streaming.incremental import load_incremental

        for table, delta in load_incremental(
            spark, args.csv_dir, args.target, args.tables, header=not args.no_header, mode=args.mode
        ).items():
            print(f"{table}: {delta.count()} new rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
