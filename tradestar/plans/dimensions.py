"""Builders of the nine dimensions.

Each builder is a lazy DataFrame transformation over the bronze (or
cleaned) tables followed by :func:`dense_key`; the role-playing twins
(origin / destination country and currency) are one build renamed twice.
Ties in a sort are broken over all columns so keys never depend on the
order in which rows happen to arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.calendar import time_attributes
from tradestar.functions.coerce import to_integer
from tradestar.operators.keys import SMALL_KEY_ROWS, dense_key

# Label of the default category and prefix of synthesized products.
NO_CATEGORY = "SEM_CATEGORIA"
PRODUCT_PREFIX = "PRODUTO "


def base_tempo(fx_clean: DataFrame) -> DataFrame:
    return fx_clean.select("data").distinct()


def dim_tempo(
    fx_clean: DataFrame, rows: int | None = None, base: DataFrame | None = None, small_rows: int = SMALL_KEY_ROWS
) -> DataFrame:
    """One row per distinct FX timestamp, keyed in ascending time.

    ``data`` (the full timestamp) stays as the internal natural key of the
    fact lookup; ``data_referencia`` is its date.
    """
    src = base if base is not None else base_tempo(fx_clean)
    keyed = dense_key(src, ["data"], "sk_tempo", rows=rows, small_rows=small_rows)
    attrs = time_attributes(F.col("data"))
    return keyed.select("sk_tempo", *[v.alias(k) for k, v in attrs.items()], "data")


def base_paises(paises: DataFrame, blocos: DataFrame) -> DataFrame:
    blocs = blocos.select(F.col("id").alias("_bloco_id"), F.col("nome").alias("bloco_nome"))
    enriched = paises.join(blocs, paises["bloco_id"] == blocs["_bloco_id"], "left")
    return enriched.select("id", "nome", "codigo_iso", "bloco_nome").distinct()


def dim_paises(
    paises: DataFrame,
    blocos: DataFrame,
    rows: int | None = None,
    base: DataFrame | None = None,
    small_rows: int = SMALL_KEY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(origin, destination) country dimensions with their economic bloc."""
    src = base if base is not None else base_paises(paises, blocos)
    base = dense_key(src, ["id", "nome", "codigo_iso", "bloco_nome"], "_sk", rows=rows, small_rows=small_rows)

    def role(r: str) -> DataFrame:
        return base.select(
            F.col("_sk").alias(f"sk_pais_{r}"),
            F.col("id").alias(f"id_pais_{r}"),
            F.col("nome").alias(f"nome_pais_{r}"),
            F.col("codigo_iso").alias(f"codigo_iso_pais_{r}"),
            F.col("bloco_nome").alias(f"bloco_economico_pais_{r}"),
        )

    return role("origem"), role("destino")


def base_categoria(spark: SparkSession, categorias: DataFrame | None, unknown_member: bool = False) -> DataFrame:
    """Categories before keys; with ``unknown_member`` also ``(0, SEM_CATEGORIA)``, if no category has id 0."""
    if categorias is None:
        base = spark.createDataFrame(
            [(0, NO_CATEGORY)],
            T.StructType(
                [
                    T.StructField("id_categoria_produto", T.LongType(), False),
                    T.StructField("descricao_categoria_produto", T.StringType(), False),
                ]
            ),
        )
    else:
        base = categorias.select(
            F.col("id").alias("id_categoria_produto"), F.col("descricao").alias("descricao_categoria_produto")
        ).distinct()
        if unknown_member:
            zero = spark.range(1).select(F.col("id").alias("id_categoria_produto"), F.lit(NO_CATEGORY).alias("descricao_categoria_produto"))
            base = base.unionByName(zero.join(base.filter("id_categoria_produto = 0"), "id_categoria_produto", "left_anti"))
    return base


def dim_categoria_produto(
    spark: SparkSession,
    categorias: DataFrame | None,
    rows: int | None = None,
    base: DataFrame | None = None,
    small_rows: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Categories by id; a single ``(0, SEM_CATEGORIA)`` row when the file is absent."""
    base = base if base is not None else base_categoria(spark, categorias)
    order = ["id_categoria_produto", "descricao_categoria_produto"]
    keyed = dense_key(base, order, "sk_categoria_produto", rows=rows, small_rows=small_rows)
    return keyed.select("sk_categoria_produto", "id_categoria_produto", "descricao_categoria_produto")


def base_produto(produtos: DataFrame | None, categorias_dim: DataFrame, transacoes_clean: DataFrame) -> DataFrame:
    """One row per product id, before keys (see :func:`dim_produto`)."""
    if produtos is not None:
        norm = produtos.select(
            F.col("id").alias("id_produto"),
            F.col("descricao").alias("descricao_produto"),
            F.col("codigo_ncm").alias("codigo_ncm"),
            F.coalesce(F.col("categoria_id"), F.lit(0).cast("long")).alias("id_categoria_produto"),
        )
    else:
        norm = transacoes_clean.select(F.col("produto_id").alias("id_produto")).distinct().select(
            "id_produto",
            F.concat(F.lit(PRODUCT_PREFIX), F.col("id_produto").cast("string")).alias("descricao_produto"),
            F.lit(None).cast("string").alias("codigo_ncm"),
            F.lit(0).cast("long").alias("id_categoria_produto"),
        )
    cats = categorias_dim.select("id_categoria_produto", "descricao_categoria_produto")
    with_cat = norm.join(cats, "id_categoria_produto", "left").select(
        "id_produto",
        "descricao_produto",
        "codigo_ncm",
        "id_categoria_produto",
        F.coalesce(F.col("descricao_categoria_produto"), F.lit(NO_CATEGORY)).alias("categoria_produto"),
    )
    # keep-first per id over a total order of the remaining columns (partial aggregate)
    first = with_cat.groupBy("id_produto").agg(
        F.min(F.struct("descricao_produto", "codigo_ncm", "id_categoria_produto", "categoria_produto")).alias("_p")
    )
    return first.select("id_produto", "_p.*")


def dim_produto(
    produtos: DataFrame | None,
    categorias_dim: DataFrame,
    transacoes_clean: DataFrame,
    rows: int | None = None,
    base: DataFrame | None = None,
    small_rows: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Products, one row per id (the first in column order), keyed by id.

    Without a product file the products are the distinct product ids of the
    valid (or cleaned) transactions, named ``PRODUTO <id>`` with category 0.  A product
    with no category gets category id 0; its category name (not stored) is
    ``SEM_CATEGORIA`` when id 0 is not a known category.
    """
    one = base if base is not None else base_produto(produtos, categorias_dim, transacoes_clean)
    keyed = dense_key(one, ["id_produto"], "sk_produto", rows=rows, small_rows=small_rows)
    return keyed.select(
        "sk_produto",
        "id_produto",
        "descricao_produto",
        to_integer(F.col("codigo_ncm"), T.IntegerType()).alias("codigo_ncm_produto"),
        "codigo_ncm",
        "id_categoria_produto",
        "categoria_produto",
    )


def base_moedas(moedas: DataFrame) -> DataFrame:
    return moedas.select("id", "descricao", "pais").distinct()


def dim_moedas(
    moedas: DataFrame, rows: int | None = None, base: DataFrame | None = None, small_rows: int = SMALL_KEY_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(origin, destination) currency dimensions."""
    src = base if base is not None else base_moedas(moedas)
    keyed = dense_key(src, ["id", "descricao", "pais"], "_sk", rows=rows, small_rows=small_rows)

    def role(r: str) -> DataFrame:
        return keyed.select(
            F.col("_sk").alias(f"sk_moeda_{r}"),
            F.col("id").alias(f"id_moeda_{r}"),
            F.col("descricao").alias(f"descricao_moeda_{r}"),
            F.col("pais").alias(f"pais_moeda_{r}"),
        )

    return role("origem"), role("destino")


def base_simple(src: DataFrame, name: str) -> DataFrame:
    return src.select(F.col("id").alias(f"id_{name}"), F.col("descricao").alias(f"descricao_{name}")).distinct()


def _simple_dim(src: DataFrame, name: str, rows: int | None, base: DataFrame | None, small_rows: int) -> DataFrame:
    b = base if base is not None else base_simple(src, name)
    keyed = dense_key(b, [f"id_{name}", f"descricao_{name}"], f"sk_{name}", rows=rows, small_rows=small_rows)
    return keyed.select(f"sk_{name}", f"id_{name}", f"descricao_{name}")


def dim_tipo_transacao(
    tipos: DataFrame, rows: int | None = None, base: DataFrame | None = None, small_rows: int = SMALL_KEY_ROWS
) -> DataFrame:
    return _simple_dim(tipos, "tipo_transacao", rows, base, small_rows)


def dim_transporte(
    transportes: DataFrame, rows: int | None = None, base: DataFrame | None = None, small_rows: int = SMALL_KEY_ROWS
) -> DataFrame:
    return _simple_dim(transportes, "transporte", rows, base, small_rows)
