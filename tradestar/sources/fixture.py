"""Bronze-shaped views over the driver's TPC-H-like test tables.

The view bodies run unchanged in Spark SQL and in DuckDB, so the same text
is the input of the Spark pipeline and, as CTEs, of every oracle query.
Dirty rows are injected on purpose (duplicates, invalid numbers, invalid
dates, unknown product and currency ids, a country without a bloc, a product
without a category).  No double arithmetic is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradestar.sources.bronze import Bronze, read_bronze_parquet, standardize_bronze, standardize_table, write_bronze
from tradestar.sources.writers import parquet_writer, write_all

SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Ordered: later views read earlier ones.
FIXTURE_VIEWS: dict[str, str] = {
    "b_blocos": """
select cast(r_regionkey + 1 as int) id, r_name nome from region
""",
    "b_paises": """
select cast(n_nationkey + 1 as int) id, n_name nome,
       concat('N', lpad(cast(n_nationkey as string), 2, '0')) codigo_iso,
       case when n_nationkey = 24 then null else concat(cast(n_regionkey + 1 as string), '.0') end bloco_id
from nation
""",
    "b_moedas": """
select cast(n_nationkey + 1 as int) id, concat('Moeda ', n_name) descricao, n_name pais
from nation where n_nationkey < 24
""",
    "b_categorias": """
select cast(row_number() over (order by p_type) as int) id, p_type descricao
from (select distinct p_type from part) x
""",
    "b_produtos": """
select p.p_partkey id, p.p_name descricao,
       case when p.p_size = 50 then null else c.id end categoria_id,
       lpad(cast(p.p_partkey as string), 8, '0') codigo_ncm
from part p join b_categorias c on p.p_type = c.descricao
""",
    "b_tipos": """
select cast(row_number() over (order by descricao) as int) id, descricao
from (select distinct concat(l_returnflag, l_linestatus) descricao from lineitem) x
""",
    "b_transportes": """
select distinct cast(substr(o_orderpriority, 1, 1) as int) id, substr(o_orderpriority, 3) descricao from orders
""",
    "b_cambios": """
with base as (
  select o_orderkey id, cast(o_orderdate as date) d,
         cast(o_custkey % 25 + 1 as int) moeda_origem, cast(o_orderkey % 25 + 1 as int) moeda_destino,
         cast(cast((o_orderkey * 7919 + o_custkey) % 50000 + 1 as decimal(10,0)) * cast('0.0001' as decimal(5,4)) as decimal(18,8)) taxa
  from orders)
select id, case when id % 41 = 0 then 'invalida' else cast(d as string) end data, moeda_origem, moeda_destino,
       case when id % 50 = 1 then 'abc' when id % 53 = 0 then '0' else cast(taxa as string) end taxa_cambio
from base
union all
select id, cast(cast('2002-01-01' as date) as string), moeda_origem, moeda_destino, cast(taxa as string)
from base where id % 7 = 0
""",
    "b_transacoes": """
with base as (
  select l.l_orderkey * 10 + l.l_linenumber id, t.id tipo_id,
         cast(s.s_nationkey + 1 as int) pais_origem, cast(c.c_nationkey + 1 as int) pais_destino,
         case when l.l_partkey % 107 = 5 then l.l_partkey + 10000000 else l.l_partkey end produto_id,
         case when l.l_partkey % 101 = 3 then 'x' when l.l_partkey % 103 = 4 then '-1.00'
              else cast(cast(l.l_extendedprice as decimal(15,2)) as string) end valor_monetario,
         case when l.l_suppkey % 97 = 2 then null when l.l_suppkey % 89 = 3 then '0'
              else cast(cast(l.l_quantity as int) as string) end quantidade,
         cast(substr(o.o_orderpriority, 1, 1) as int) transporte_id, l.l_orderkey cambio_id, l.l_orderkey k
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey
  join supplier s on l.l_suppkey = s.s_suppkey
  join b_tipos t on t.descricao = concat(l.l_returnflag, l.l_linestatus))
select id, tipo_id, pais_origem, pais_destino, produto_id, valor_monetario, quantidade, transporte_id, cambio_id from base
union all
select id, tipo_id, pais_origem, pais_destino, produto_id, valor_monetario, quantidade, transporte_id, cambio_id from base
where k % 20 = 0
union all
select id, tipo_id, pais_origem, pais_destino, produto_id, valor_monetario || '0', quantidade || '.0', transporte_id, cambio_id from base
where k % 20 = 10 and valor_monetario <> 'x'
union all
select id, tipo_id, pais_origem, pais_destino, produto_id, v, q, transporte_id, case when v = '99999999999999.50' then cambio_id else -cambio_id end
from base, (select '1E100' v, '1' q union all select '10E99', '1.0' union all select '100e+98', '10E-1'
            union all select '1.00000000001', '5' union all select '1.00000000002', '5' union all select '100000000001e-11', '005.'
            union all select '.5', '2' union all select '0.50000', '2' union all select '12345678901234567890123456789012345678901', '1'
            union all select '1234567890123456789012345678901234567890.1e1', '1' union all select '99999999999999.50', '1') odd
where k % 200 = 5
""",
}

# Fixture view -> bronze table name.
FIXTURE_TO_BRONZE = {
    "b_transacoes": "transacoes",
    "b_paises": "paises",
    "b_moedas": "moedas",
    "b_cambios": "cambios",
    "b_tipos": "tipos_transacoes",
    "b_transportes": "transportes",
    "b_blocos": "blocos_economicos",
    "b_produtos": "produtos",
    "b_categorias": "categoria_produtos",
}


# Bronze tables that the views of others read.
FIXTURE_READS = {"transacoes": ["tipos_transacoes"], "produtos": ["categoria_produtos"]}


def register_sources(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver's parquet tables as temp views (column-pruned scans)."""
    for name in SOURCE_TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def fixture_bronze(
    spark: SparkSession, sf_dir: str, with_products: bool = True, with_categories: bool = True, stored: dict[str, DataFrame] | None = None
) -> Bronze:
    """The nine bronze tables derived from the test tables of ``sf_dir``; ``stored`` ones are read as they are."""
    register_sources(spark, sf_dir)
    frames = {}
    for view, body in FIXTURE_VIEWS.items():
        df = (stored or {}).get(FIXTURE_TO_BRONZE[view])
        if df is None:
            df = spark.sql(body)
        df.createOrReplaceTempView(view)
        frames[FIXTURE_TO_BRONZE[view]] = df
    if not with_products:
        frames["produtos"] = None
    if not with_categories:
        frames["categoria_produtos"] = None
    return standardize_bronze(frames)


def extract_bronze(spark: SparkSession, sf_dir: str, out_dir: str) -> Bronze:
    """Extract step: write the nine bronze tables as Parquet and read them back.

    The transform then scans plain files (column-pruned, no re-evaluation of
    the source joins by each consumer), like an extract to the bronze layer.
    """
    write_bronze(fixture_bronze(spark, sf_dir), out_dir, fmt="parquet")
    return read_bronze_parquet(spark, out_dir)


def extract_tables(spark: SparkSession, sf_dir: str, out_dir: str, tables: list[str]) -> dict[str, DataFrame]:
    """:func:`extract_bronze` for some of the bronze tables; of the others only those that these read are computed.

    A table that others read (:data:`FIXTURE_READS`) is stored first and joined from its files: its size is
    known then, so the planner broadcasts it if it is small, instead of shuffling the other side
    before the size is seen.
    """
    first = sorted({r for t in tables for r in FIXTURE_READS.get(t, [])})
    stored: dict[str, DataFrame] = {}

    def store(names: list[str]) -> None:
        frames = fixture_bronze(spark, sf_dir, stored=stored).tables()
        write_all({t: frames[t] for t in names}, parquet_writer(lambda t: f"{out_dir}/{t}"))
        stored.update({t: standardize_table(t, spark.read.parquet(f"{out_dir}/{t}")) for t in names})

    for names in (first, [t for t in tables if t not in first]):
        if names:
            store(names)
    return stored
