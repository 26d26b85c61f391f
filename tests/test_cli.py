"""Command line: build, views, check, incremental (in-process)."""

from __future__ import annotations

import os

from tests.conftest import SF_SMALL
from tests.test_sources import BRONZE_CSV, write_csv_dir
from tradestar.__main__ import main


def test_build_views_check(spark, tmp_dir, capsys):
    wh = os.path.join(tmp_dir, "wh")
    assert main(["build", "--test-tables", SF_SMALL, "--warehouse", wh, "--audit"]) == 0
    out = capsys.readouterr().out
    assert "'fato': 3959" in out
    assert main(["views", "--warehouse", wh, "--view", "3", "--rows", "2"]) == 0
    assert "view 3" in capsys.readouterr().out
    assert main(["check", "--warehouse", wh]) == 0


def test_incremental_command(spark, tmp_dir, capsys):
    src = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV)
    target = os.path.join(tmp_dir, "origem")
    assert main(["incremental", "--csv-dir", src, "--target", target, "--tables", "cambios", "transacoes"]) == 0
    assert "transacoes: 4 new rows" in capsys.readouterr().out
    assert main(["incremental", "--csv-dir", src, "--target", target, "--tables", "transacoes"]) == 0
    assert "transacoes: 0 new rows" in capsys.readouterr().out


def test_extract_from_jdbc_to_bronze_files(spark, tmp_dir):
    from tradestar.sources.bronze import read_bronze_csv, read_bronze_parquet
    from tradestar.sources.jdbc import write_jdbc_table

    url = "jdbc:derby:memory:tradestar_cli;create=true"
    bronze = read_bronze_csv(spark, write_csv_dir(os.path.join(tmp_dir, "src"), BRONZE_CSV))
    for name, df in bronze.tables().items():
        write_jdbc_table(df, url, name, mode="overwrite")
    out = os.path.join(tmp_dir, "bronze_out")
    assert main(["extract", "--jdbc-url", url, "--jdbc-partitions", "2", "--bronze-out", out]) == 0
    assert sorted(read_bronze_parquet(spark, out).transacoes.collect()) == sorted(bronze.transacoes.collect())
    out_csv = os.path.join(tmp_dir, "bronze_csv")
    assert main(["extract", "--jdbc-url", url, "--bronze-out", out_csv, "--format", "csv"]) == 0
    assert read_bronze_csv(spark, out_csv).paises.count() == 3
