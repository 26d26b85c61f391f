"""What the build moves and writes: keys above the broadcast bound, frequent keys, columns that
are not stored, bronze tables that a query does not need."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tradestar.operators.clean import clean_transacoes
from tradestar.operators.keys import dense_key, frequent_values
from tradestar.plans import fact as FT
from tradestar.plans import pipeline
from tradestar.plans.star import build_star
from tradestar.schemas import FACT
from tradestar.sources.bronze import standardize_bronze

IDS = 1500  # FX ids and products: more than the frequent values can be


def _frame(spark, columns, rows):
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"{c} string" for c in columns.split()))


def _bronze(spark):
    """Every FX id and product is used; id 7 of both is frequent, and rows of any kind come twice, one pair in other spellings."""
    t = [(i, i % 3 + 1, i % 4 + 1, i % 5 + 1, i % IDS, f"{i % 90 + 1}.50", i % 9 + 1, 1, (i * 7) % IDS) for i in range(2 * IDS)]
    t += [(10_000 + i, 1, 1, 1, 7, "2.25", 3, 1, 7) for i in range(400)]
    t += [(*r[:5], f"{r[5]}0", f"{r[6]}.0", *r[7:]) for r in t if r[0] % 5 == 0] + t[::11] + t[-50:] * 4
    t += [(50_000, 1, 1, 1, 99_999, "1", 1, 1, 3), (50_001, 1, 1, 1, 3, "1", 1, 1, 99_999), (50_002, 1, 1, 1, None, "1", 1, 1, 3), (50_003, 1, 1, 1, 3, "1", 1, 1, None)]
    return standardize_bronze(
        {
            "transacoes": _frame(spark, "id tipo_id pais_origem pais_destino produto_id valor_monetario quantidade transporte_id cambio_id", t).repartition(6),
            "paises": _frame(spark, "id nome codigo_iso bloco_id", [(i, f"P{i}", f"I{i}", 1) for i in range(1, 5)]),
            "moedas": _frame(spark, "id descricao pais", [(i, f"M{i}", f"P{i}") for i in (1, 2)]),
            "cambios": _frame(spark, "id data moeda_origem moeda_destino taxa_cambio", [(i, f"2024-0{i % 9 + 1}-11", i % 2 + 1, 1, f"1.{i % 7}5") for i in range(IDS) if i % 50]),
            "tipos_transacoes": _frame(spark, "id descricao", [(i, f"T{i}") for i in (1, 2, 3)]),
            "transportes": _frame(spark, "id descricao", [(1, "X")]),
            "blocos_economicos": _frame(spark, "id nome", [(1, "B")]),
            "produtos": _frame(spark, "id descricao categoria_id codigo_ncm", [(i, f"D{i}", 1, i) for i in range(IDS)]),
            "categoria_produtos": _frame(spark, "id descricao", [(1, "C")]),
        }
    )


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def built(spark):
    bronze = _bronze(spark)
    return bronze, build_star(spark, bronze)


@pytest.mark.parametrize("bound", [1, 10])
def test_same_star_above_and_below_the_broadcast_bound(spark, built, bound):
    bronze, plain = built
    star = build_star(spark, bronze, max_broadcast_rows=bound, small_key_rows=10)
    assert _rows(star.tables()[FACT]) == _rows(plain.tables()[FACT])
    assert _rows(star.quarantine) == _rows(plain.quarantine)
    assert star.audit_metrics == plain.audit_metrics
    assert star.audit_metrics["linhas"] == clean_transacoes(bronze.transacoes).count()


def test_frequent_and_other_keys_join_as_one(spark, built):
    bronze, _ = built
    keyed = bronze.cambios.select(F.col("id").alias("cambio_id"), "taxa_cambio")
    want = FT.transaction_rows(clean_transacoes(bronze.transacoes)).join(keyed, "cambio_id", "left")
    for share in (0.001, 0.02, 0.9):  # some, few and no frequent values
        got = FT.join_large(bronze.transacoes, {"cambio_id": keyed}, share)
        assert _rows(got.select(want.columns)) == _rows(want)
    assert 7 in frequent_values(bronze.transacoes, "cambio_id", 0.02) and len(frequent_values(bronze.transacoes, "cambio_id", 0.02)) <= 50


def test_one_shuffle_removes_duplicates_and_joins(spark, built):
    bronze, _ = built
    rest = FT.transaction_rows(clean_transacoes(bronze.transacoes, near="cambio_id"))
    other = spark.range(9).select(F.col("id").alias("cambio_id"), F.lit(1).alias("x"))
    plan = rest.join(other.hint("merge"), "cambio_id", "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2, plan


def test_rows_are_written_once_before_the_fact_and_without_what_follows_from_them(spark, built):
    _, star = built
    stored = spark.read.parquet(*star.staged.inputFiles()).columns
    assert not set(FT.MEASURES) & set(stored) and "motivo" in stored
    assert set(FT.MEASURES) <= set(star.staged.columns)
    folder = os.path.dirname(os.path.dirname(star.staged.inputFiles()[0].removeprefix("file://")))
    assert not [n for n in os.listdir(folder) if n.startswith("unnumbered_sk_transacao")]


def test_columns_added_behind_the_shuffle_are_judged_once(spark):
    df = spark.range(2000).select((F.col("id") * 7 % 2000).alias("a"))
    seen = []

    def then(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.withColumn("even", F.col("a") % 2 == 0)

    out = dense_key(df, ["a"], "sk", keep=F.col("even"), then=then)
    assert "rangepartitioning" in seen[0]
    got = {r.a: r.sk for r in out.collect()}
    assert got == {a: a // 2 + 1 if a % 2 == 0 else None for a in range(2000)}


def test_unknown_member_above_the_broadcast_bound(spark, built):
    bronze, _ = built
    strays = bronze.produtos.withColumn("categoria_id", F.when(F.col("id") % 3 > 0, F.col("categoria_id")))
    other = type(bronze)(**{**bronze.tables(), "produtos": strays})
    plain = build_star(spark, other, unknown_member=True)
    star = build_star(spark, other, unknown_member=True, max_broadcast_rows=10, small_key_rows=10)
    assert _rows(star.tables()[FACT]) == _rows(plain.tables()[FACT])
    assert star.audit_metrics == plain.audit_metrics and star.audit_metrics["sem_sk_categoria_produto"] == 0
    assert not set(FT.MEASURES) & set(spark.read.parquet(*star.staged.inputFiles()).columns)


def test_stored_tables_of_the_build_are_zstd(spark, built):
    files = built[1].staged.inputFiles()
    assert files and all(".zstd." in f for f in files)


def _sources(spark, folder):
    ts = "cast(concat('1995-01-', lpad(cast(id % 28 + 1 as string), 2, '0')) as timestamp_ntz)"
    tables = {
        "region": spark.range(3).selectExpr("cast(id as int) r_regionkey", "concat('R', id) r_name"),
        "nation": spark.range(6).selectExpr("cast(id as int) n_nationkey", "concat('N', id) n_name", "cast(id % 3 as int) n_regionkey"),
        "customer": spark.range(5).selectExpr("id c_custkey", "cast(id as int) c_nationkey"),
        "supplier": spark.range(4).selectExpr("id s_suppkey", "cast(id as int) s_nationkey"),
        "part": spark.range(7).selectExpr("id p_partkey", "concat('p', id) p_name", "concat('t', id % 2) p_type", "cast(id as int) p_size"),
        "orders": spark.range(30).selectExpr("id o_orderkey", "id % 5 o_custkey", f"{ts} o_orderdate", "'1-URGENT' o_orderpriority"),
        "lineitem": spark.range(60).selectExpr(
            "id % 30 l_orderkey", "cast(id div 30 as int) l_linenumber", "id % 7 l_partkey", "id % 4 l_suppkey", "cast(id + 1 as double) l_quantity",
            "cast(id * 2.5 + 1 as double) l_extendedprice", "'A' l_returnflag", "if(id % 2 = 0, 'F', 'O') l_linestatus",
        ),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def _never(*args, **kwargs):
    raise AssertionError("the star is built")


def test_headerless_csv_extracts_the_transactions_alone(spark, tmp_dir, monkeypatch):
    _sources(spark, tmp_dir)
    monkeypatch.setattr(pipeline, "build_star", _never)
    raw = E.queries()["csv_headerless"](spark, tmp_dir)
    found = pipeline._BRONZE[(spark.sparkContext.applicationId, tmp_dir)]
    # the transactions' view reads the types, which are stored first
    assert set(found) == {"tipos_transacoes", "transacoes"}
    want = found["transacoes"].select(*[F.col(c).cast("string") for c in found["transacoes"].columns])
    assert _rows(raw) == _rows(want) and raw.count() > 60


def test_cleaned_rates_extract_the_rates_alone(spark, tmp_dir, monkeypatch):
    _sources(spark, tmp_dir)
    monkeypatch.setattr(pipeline, "build_star", _never)
    fx = E.queries()["clean_cambios"](spark, tmp_dir)
    # the rate of id 1 is a text; id 0 has a second row, with a date
    assert sorted(r.id for r in fx.collect()) == [0, *range(2, 30)]
    assert set(pipeline._BRONZE[(spark.sparkContext.applicationId, tmp_dir)]) == {"cambios"}
