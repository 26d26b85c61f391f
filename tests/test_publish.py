"""Versioned publish of the warehouse, the id-0 category member, and one run of the staging."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from test_semantics import make_bronze

from tradestar.plans.star import build_star, published, read_star, write_star


def test_failed_write_leaves_the_old_star_whole(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wh")
    star = build_star(spark, make_bronze(spark))
    write_star(star, path)
    before = {n: sorted(map(str, df.collect())) for n, df in read_star(spark, path).tables().items()}
    other = build_star(spark, make_bronze(spark, {"paises": [("9", "Novo", "NOV", None)]}))
    other.fato_transacoes_internacionais = star.fact.withColumn("sk_tempo", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_star(other, path)
    assert {n: sorted(map(str, df.collect())) for n, df in read_star(spark, path).tables().items()} == before
    assert len(published(spark, path)) == 1


def test_readers_follow_the_latest_version_and_old_ones_go(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wh")
    first = write_star(build_star(spark, make_bronze(spark)), path)
    reader = read_star(spark, path)
    n = reader.dim_pais_origem.count()
    second = write_star(build_star(spark, make_bronze(spark, {"paises": [("1", "Brasil", "BRA", "1.0"), ("2", "Alemanha", "DEU", "2.0")]})), path)
    assert read_star(spark, path).dim_pais_origem.count() == 2
    assert reader.dim_pais_origem.count() == n  # the version it opened is still there
    write_star(build_star(spark, make_bronze(spark)), path)
    assert [v for v, _ in published(spark, path)] == [3, 2]
    assert not os.path.exists(first) and os.path.exists(second)
    with pytest.raises(ValueError):
        write_star(build_star(spark, make_bronze(spark)), path, mode="errorifexists")


def test_unknown_member(spark):
    products = [("1", "Cafe", "1", "09011110"), ("2", "TV", "99", "85287200"), ("3", "Sem", None, None)]
    sale = lambda n, product: (n, "1", "1", "2", product, "100", "1", "1", "10")
    bronze = make_bronze(spark, {"produtos": products, "transacoes": [sale("1", "1"), sale("2", "2"), sale("3", "3"), sale("4", "77")]})
    assert sorted(r.id_transacao for r in build_star(spark, bronze).fact.collect()) == [1]
    star = build_star(spark, bronze, unknown_member=True)
    categories = {r.sk_categoria_produto: r for r in star.dim_categoria_produto.collect()}
    assert {r.id_transacao: categories[r.sk_categoria_produto].id_categoria_produto for r in star.fact.collect()} == {1: 1, 2: 0, 3: 0}
    assert [r.descricao_categoria_produto for r in categories.values() if r.id_categoria_produto == 0] == ["SEM_CATEGORIA"]
    # an id-0 category of the source stays the only one
    kept = build_star(spark, make_bronze(spark, {"produtos": products, "categoria_produtos": [("0", "Outros"), ("1", "ALIMENTOS")]}), unknown_member=True)
    assert sorted(r.descricao_categoria_produto for r in kept.dim_categoria_produto.collect()) == ["ALIMENTOS", "Outros"]


def test_staging_runs_once(spark):
    """The rows pass the staging's accumulators once: range sampling reads the stored rows."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    from tradestar.operators.keys import dense_key

    df = spark.range(1000).repartition(4).mapInArrow(count, "id long")
    out = dense_key(df, ["id"], "sk")
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(i, i + 1) for i in range(1000)]
    assert seen.value == 1000
