"""Bronze readers and writers: CSV (BOM, null tokens, header / no header,
optional files), Parquet round trip, JDBC through in-process Derby."""

from __future__ import annotations

import os

from tradestar.plans.star import build_star, read_star, write_star
from tradestar.sources.bronze import read_bronze_csv, read_bronze_parquet, read_csv_table, write_bronze
from tradestar.sources.jdbc import read_bronze_jdbc, read_jdbc_table, write_jdbc_table, write_star_jdbc

BRONZE_CSV = {
    "blocos_economicos": "id,nome\n1,MERCOSUL\n2,UNIÃO EUROPEIA\n",
    "paises": "id,nome,codigo_iso,bloco_id\n1,Brasil,BRA,1.0\n2,Alemanha,DEU,2.0\n3,Japão,JPN,\n",
    "moedas": "id,descricao,pais\n1,Real,Brasil\n2,Euro,Zona do Euro\n",
    "tipos_transacoes": "id,descricao\n1,EXPORTACAO\n",
    "transportes": "id,descricao\n1,MARITIMO\n",
    "categoria_produtos": "id,descricao\n1,ALIMENTOS\n",
    "produtos": "id,descricao,categoria_id,codigo_ncm\n1,Cafe,1,09011110\n",
    "cambios": "id,data,moeda_origem,moeda_destino,taxa_cambio\n10,2024-01-01,1,2,0.5\n11,NaT,1,2,1\n12,2024-01-02,1,2,NA\n",
    "transacoes": (
        "id,tipo_id,pais_origem,pais_destino,produto_id,valor_monetario,quantidade,transporte_id,cambio_id\n"
        "1,1,1,2,1,100.00,10,1,10\n"
        "2,1,1,3,1,NaN,10,1,10\n"
        "3,1,2,1,1,20.00,N/A,1,10\n"
        "4,1,2,1,1,30.00,3,1,11\n"
    ),
}


def write_csv_dir(path, tables, bom=True, skip=()):
    os.makedirs(path, exist_ok=True)
    for name, text in tables.items():
        if name in skip:
            continue
        with open(os.path.join(path, f"{name}.csv"), "w", encoding="utf-8-sig" if bom else "utf-8") as fh:
            fh.write(text)
    return path


def test_csv_bom_and_null_tokens(spark, tmp_dir):
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV)
    b = read_bronze_csv(spark, d)
    assert b.paises.columns == ["id", "nome", "codigo_iso", "bloco_id"]  # BOM stripped
    paises = {r["id"]: r for r in b.paises.collect()}
    assert paises[1]["bloco_id"] == 1 and paises[3]["bloco_id"] is None
    tx = {r["id"]: r for r in b.transacoes.collect()}
    assert tx[2]["valor_monetario"] is None and tx[3]["quantidade"] is None
    star = build_star(spark, b)
    assert sorted(r["id_transacao"] for r in star.fact.collect()) == [1]


def test_csv_optional_files_absent(spark, tmp_dir):
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV, skip=("produtos", "categoria_produtos"))
    b = read_bronze_csv(spark, d)
    assert b.produtos is None and b.categoria_produtos is None
    star = build_star(spark, b)
    assert [r["descricao_categoria_produto"] for r in star.dim_categoria_produto.collect()] == ["SEM_CATEGORIA"]
    assert sorted(r["id_transacao"] for r in star.fact.collect()) == [1]


def test_csv_product_columns_optional(spark, tmp_dir):
    tables = dict(BRONZE_CSV, produtos="id,descricao\n1,Cafe\n")
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), tables)
    b = read_bronze_csv(spark, d)
    row = b.produtos.collect()[0]
    assert row["categoria_id"] is None and row["codigo_ncm"] is None


def test_headerless_record(spark, tmp_dir):
    p = os.path.join(tmp_dir, "transacoes_novas.csv")
    with open(p, "w") as fh:
        fh.write("100001,2,1,5,1,125000.50,80,1,1\n")
    row = read_csv_table(spark, p, "transacoes", header=False).collect()[0]
    assert row["id"] == "100001" and row["valor_monetario"] == "125000.50" and row["cambio_id"] == "1"


def test_missing_required_file_raises(spark, tmp_dir):
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV, skip=("moedas",))
    try:
        read_bronze_csv(spark, d)
    except Exception as exc:  # AnalysisException: path does not exist
        assert "moedas" in str(exc)
    else:
        raise AssertionError("expected a missing-file error")


def test_bronze_and_warehouse_roundtrip(spark, tmp_dir):
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV)
    b = read_bronze_csv(spark, d)
    write_bronze(b, os.path.join(tmp_dir, "pq"), fmt="parquet")
    write_bronze(b, os.path.join(tmp_dir, "csv"), fmt="csv")
    b2 = read_bronze_parquet(spark, os.path.join(tmp_dir, "pq"))
    b3 = read_bronze_csv(spark, os.path.join(tmp_dir, "csv"))
    for other in (b2, b3):
        assert sorted(other.transacoes.collect()) == sorted(b.transacoes.collect())
    star = build_star(spark, b2)
    write_star(star, os.path.join(tmp_dir, "wh"))
    wh = read_star(spark, os.path.join(tmp_dir, "wh"))
    # file sources read every column as nullable: compare names and types
    assert [(f.name, f.dataType) for f in wh.fact.schema] == [
        (f.name, f.dataType) for f in star.tables()["fato_transacoes_internacionais"].schema
    ]
    assert wh.fact.collect() == star.tables()["fato_transacoes_internacionais"].collect()


def test_warehouse_as_catalog_tables(spark, tmp_dir):
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV)
    star = build_star(spark, read_bronze_csv(spark, d))
    write_star(star, os.path.join(tmp_dir, "wh"), database="dw_test")
    by_name = read_star(spark, database="dw_test")
    assert by_name.fact.count() == 1
    assert spark.sql("select count(*) from dw_test.dim_pais_origem").collect()[0][0] == 3


DERBY = "jdbc:derby:memory:tradestar_test;create=true"


def test_jdbc_roundtrip_in_process_derby(spark, tmp_dir):
    """Embedded, in-memory Derby lives inside the Spark JVM: no server, no port."""
    d = write_csv_dir(os.path.join(tmp_dir, "bronze"), BRONZE_CSV)
    b = read_bronze_csv(spark, d)
    for name, df in b.tables().items():
        write_jdbc_table(df, DERBY, name, mode="overwrite", batch_size=100)
    one = read_jdbc_table(spark, DERBY, "transacoes", partition_column="id", num_partitions=3)
    assert one.rdd.getNumPartitions() == 3
    assert one.count() == 4
    pushed = one.filter("id > 2").select("id")
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,2)" in plan and "ReadSchema: struct<id:bigint>" in plan
    via_jdbc = read_bronze_jdbc(spark, DERBY, partitioning={"transacoes": ("id", 2)})
    assert sorted(via_jdbc.transacoes.collect()) == sorted(b.transacoes.collect())
    star = build_star(spark, via_jdbc)
    assert sorted(r["id_transacao"] for r in star.fact.collect()) == [1]
    write_star_jdbc(star.tables(), DERBY, batch_size=500)
    assert read_jdbc_table(spark, DERBY, "fato_transacoes_internacionais").count() == 1
    assert read_jdbc_table(spark, DERBY, "dim_pais_destino").count() == 3
