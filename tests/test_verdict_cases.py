"""Cases beyond the fixture: CSV quoting, totals beyond bigint cents, tie rounding,
duplicates by value, NULL keys, injected violations, storage policy."""

from __future__ import annotations

import os
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradestar.functions.formatting import fixed_one, signed_pct
from tradestar.operators import quality as Q
from tradestar.operators.clean import clean_transacoes
from tradestar.plans import marts as M
from tradestar.schemas import BRONZE_COLUMNS, DIMENSIONS, FACT
from tradestar.session import ensure_checkpoint_dir
from tradestar.sources.bronze import read_csv_table
from tradestar.sources.jdbc import _is_missing_table
from tradestar.streaming.incremental import insert_ignore


def test_csv_reads_like_a_dataframe_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "produtos.csv")
    frame = pd.DataFrame({"id": ["1", "2", "3", "4"], "descricao": ['Tubo "PVC" 2', 'a, "b", c', "two\nlines", "back\\slash\\"], "categoria_id": ["1"] * 4, "codigo_ncm": ["00000002", ",", '"', "x"]})
    frame.to_csv(path, index=False)
    got = read_csv_table(spark, path, "produtos", multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in frame.itertuples(index=False)]
    frame[frame.id != "3"].to_csv(path, index=False)
    got = read_csv_table(spark, path, "produtos").orderBy("id").collect()
    assert [r.descricao for r in got] == list(frame[frame.id != "3"].descricao)


def test_percent_rounds_as_its_binary_value(spark):
    rnd = random.Random(3)
    xs = [0.0, 0.25, 0.75, 12.25, 0.15, 0.05, 0.35, 99.95, 99.949999, 100.0, 1e-9, -0.04, -0.25, -12.35, 33.333333333333336, 123456.25]
    xs += [rnd.uniform(-200, 200) for _ in range(500)] + [k / 20 for k in range(-300, 300)] + [k / 8 for k in range(200)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed_one(F.col("x")).alias("t"), signed_pct(F.col("x")).alias("s")).collect()
    assert [r for r in got if r.t != f"{r.x:.1f}" or r.s != f"{r.x:+.1f}%"] == []


def test_cards_hold_totals_beyond_bigint_cents(spark):
    fact = spark.createDataFrame([(1, "9999999999999.99", 5)] * 11_000, "sk_tempo int, v string, quantidade_transacionada int").withColumn("valor_convertido_transacao", F.col("v").cast("decimal(15,2)")).withColumn("taxa_cambio_transacao", F.lit(1).cast("decimal(10,4)"))
    tempo = spark.createDataFrame([(1, 2024, 1)], "sk_tempo int, ano int, mes int")
    star = SimpleNamespace(fact=fact, dim_tempo=tempo, rows=None)
    row = M.executive_cards(star).first()
    assert row.valor_total_txt == "R$ 109.999.999.999.999.890,00"
    assert row.ticket_medio_txt == "R$ 9.999.999.999.999,99"


def test_duplicates_by_value(spark):
    base = {c: "1" for c in BRONZE_COLUMNS["transacoes"]}
    rows = [base | {"valor_monetario": v, "quantidade": q} for v, q in [("100.0", "2"), ("100.00", "2.0"), (" 1e2", "2"), ("100.001", "2"), ("100.00000001", "2"), ("1E100", "2"), ("2E100", "2")]]
    df = spark.createDataFrame([tuple(r[c] for c in BRONZE_COLUMNS["transacoes"]) for r in rows], ", ".join(f"{c} string" for c in BRONZE_COLUMNS["transacoes"]))
    assert clean_transacoes(df).count() == 5


def test_null_keys_are_rejected_and_loads_stay_idempotent(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    batch = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "id long, v string")
    for n in (1, 0, 0):
        rejects = []
        assert insert_ignore(spark, batch, target, ["id"], rejects=rejects).count() == n
        assert sorted(r.v for r in rejects[0].collect()) == ["b", "c"]
    assert spark.read.parquet(target).count() == 1
    # a target that repeats keys
    spark.createDataFrame([(7, "x")] * 50, "id long, v string").write.mode("append").parquet(target)
    assert insert_ignore(spark, spark.createDataFrame([(7, "y"), (8, "z")], "id long, v string"), target, ["id"]).count() == 1


def test_injected_violations_are_counted(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL

    tables = dict(E._wh(spark, SF_SMALL).tables())
    dim = next(d for d in DIMENSIONS if d == "dim_produto")
    first = tables[dim].limit(1)
    tables[dim] = tables[dim].unionByName(first).unionByName(first.withColumn("sk_produto", F.lit(-5).cast(first.schema["sk_produto"].dataType)).withColumn("descricao_produto", F.lit("x" * 300)))
    fact = tables[FACT]
    bad = fact.limit(3).withColumn("sk_transporte", F.lit(-9).cast(fact.schema["sk_transporte"].dataType)).withColumn("sk_tempo", F.lit(None).cast(fact.schema["sk_tempo"].dataType))
    tables[FACT] = fact.unionByName(bad)
    got = {(r.table_name, r.check_name): r.violations for r in Q.run_all(tables).collect()}
    assert got[dim, "pk:sk_produto"] == 1 and got[dim, "business_key:id_produto"] == 2 and got[dim, "length:descricao_produto<=255"] == 1
    assert got[FACT, "pk:sk_transacao"] == 3 and got[FACT, "not_null:sk_tempo"] == 3
    assert sum(v for (t, c), v in got.items() if c.startswith("fk:sk_transporte")) == 3
    assert not any(c == "business_key:data_referencia" for _, c in got)


def test_machine_local_fallback_is_refused_on_a_cluster():
    class Context:
        master = "yarn"
        set_to = None

        def getCheckpointDir(self):
            return self.set_to

        def setCheckpointDir(self, x):
            self.set_to = x

        def getConf(self):
            return {}

    session = SimpleNamespace(sparkContext=Context(), conf=SimpleNamespace(get=lambda *_: None))
    for folder in ("/tmp/x", "file:///tmp/x"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(session, fallback=folder)
    assert ensure_checkpoint_dir(session, fallback="hdfs:///x") == "hdfs:///x"


def test_only_a_missing_table_is_optional():
    assert _is_missing_table(Exception("ERROR 42X05: Table/View 'PRODUTOS' does not exist."))
    assert _is_missing_table(Exception("Table 'src.produtos' doesn't exist"))
    assert _is_missing_table(Exception('relation "produtos" does not exist'))
    assert not _is_missing_table(Exception("Communications link failure"))
    assert not _is_missing_table(Exception("Access denied for user"))
