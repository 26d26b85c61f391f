"""Hot keys and hot copies: one FX id and one product carry a third of the
transactions, and a third of the rows arrive four more times.  The Spark
build must equal the SQL statement of the pipeline run by DuckDB on the
same bronze files (brute force on a small fixture)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from tradestar.oracle import pipeline_statements, with_pipeline
from tradestar.plans import marts as M
from tradestar.plans.star import build_star
from tradestar.sources.bronze import read_bronze_parquet, write_bronze
from tradestar.sources.fixture import FIXTURE_TO_BRONZE, fixture_bronze


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    base = fixture_bronze(spark, SF_SMALL)
    t = base.transacoes
    hot_fx = base.cambios.agg(F.min("id")).collect()[0][0]
    hot = (F.col("id") % 3) == 0
    moved = t.withColumn("cambio_id", F.when(hot, F.lit(hot_fx)).otherwise(F.col("cambio_id"))).withColumn(
        "produto_id", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("produto_id"))
    )
    copies = moved.filter((F.col("id") % 3) == 1)
    skewed_t = moved.unionByName(copies).unionByName(copies).unionByName(copies).unionByName(copies)
    base.transacoes = skewed_t
    out = str(tmp_path_factory.mktemp("skew") / "bronze")
    write_bronze(base, out)
    return out


def test_skewed_build_matches_sql(spark, skewed):
    bronze = read_bronze_parquet(spark, skewed)
    star = build_star(spark, bronze)
    con = duck(SF_SMALL)
    for view, table in FIXTURE_TO_BRONZE.items():
        con.execute(f"create or replace view {view} as select * from read_parquet('{os.path.join(skewed, table)}/*.parquet')")
    statements = pipeline_statements()
    checks = {
        "fact": lambda s, d: star.tables()["fato_transacoes_internacionais"],
        "discard_audit": lambda s, d: star.discard_audit,
        "mart_kpis": lambda s, d: M.kpis(star),
        "mart_produtos": lambda s, d: M.top_products(star),
        "mart_blocos": lambda s, d: M.blocs(star),
    }
    for name, fn in checks.items():
        # the bronze views b_* exist in DuckDB already: no fixture CTEs
        sql = with_pipeline(statements[name], include_fixture=False)
        ok, msg = compare(spark, con, SF_SMALL, name, fn, sql)
        assert ok, msg
