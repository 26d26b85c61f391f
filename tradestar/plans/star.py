"""Whole transform: bronze bundle -> star schema, plus writer and reader.

Materialisation points (Parquet tables in the folder of
``spark.checkpoint.dir``): the cleaned FX table (read by the time dimension
and by the fact join), any dimension above the small-key bound and the
staged fact (written by the dense-key step; the fact one also feeds the
audit and the quarantine).  Small dimensions are persisted after their size
is measured and their keys assigned.  Everything else is one lazy plan per
table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.operators.clean import clean_cambios, valid_transactions
from tradestar.operators.keys import DEFAULT_BROADCAST_ROWS, SMALL_KEY_ROWS, count_rows, fits_broadcast, taken_caches
from tradestar.plans import dimensions as D
from tradestar.plans import fact as FT
from tradestar.schemas import DIMENSIONS, FACT, WAREHOUSE
from tradestar.session import WIDE_TABLE_CODEC, ensure_checkpoint_dir, materialize, path_exists, remove_path
from tradestar.sources.bronze import Bronze
from tradestar.sources.writers import parquet_writer, write_all


@dataclass
class Star:
    dim_tempo: DataFrame
    dim_pais_origem: DataFrame
    dim_pais_destino: DataFrame
    dim_categoria_produto: DataFrame
    dim_produto: DataFrame
    dim_moeda_origem: DataFrame
    dim_moeda_destino: DataFrame
    dim_tipo_transacao: DataFrame
    dim_transporte: DataFrame
    fato_transacoes_internacionais: DataFrame
    discard_audit: DataFrame | None = None
    quarantine: DataFrame | None = None
    staged: DataFrame | None = None
    audit_metrics: dict | None = None
    rows: dict[str, int] | None = None  # measured row counts of the dimensions
    cached: list[DataFrame] | None = None  # small dimensions held in memory

    def release(self) -> None:
        """Free the cached dimensions; the frames stay valid and recompute them."""
        for df in self.cached or []:
            df.unpersist()
        self.cached = None

    def tables(self) -> dict[str, DataFrame]:
        """The ten warehouse tables (stored columns, fixed order and types)."""
        out = {}
        for name in DIMENSIONS + [FACT]:
            schema = WAREHOUSE[name]
            out[name] = getattr(self, name).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        return out

    @property
    def fact(self) -> DataFrame:
        return self.fato_transacoes_internacionais

    def register_views(self) -> None:
        """Expose the ten tables as temp views under their warehouse names,
        so BI SQL written for the warehouse runs unchanged in ``spark.sql``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def dimension_bases(
    spark: SparkSession, bronze: Bronze, fx_clean: DataFrame, transacoes_clean: DataFrame, unknown_member: bool = False
) -> dict[str, DataFrame]:
    """Each dimension before keys: what :func:`count_rows` measures."""
    cat = D.base_categoria(spark, bronze.categoria_produtos, unknown_member)
    return {
        "tempo": D.base_tempo(fx_clean),
        "paises": D.base_paises(bronze.paises, bronze.blocos_economicos),
        "categoria": cat,
        "produto": D.base_produto(bronze.produtos, cat, transacoes_clean),
        "moedas": D.base_moedas(bronze.moedas),
        "tipo": D.base_simple(bronze.tipos_transacoes, "tipo_transacao"),
        "transporte": D.base_simple(bronze.transportes, "transporte"),
    }


def build_dimensions(
    spark: SparkSession,
    bronze: Bronze,
    fx_clean: DataFrame,
    transacoes_clean: DataFrame,
    rows: dict[str, int] | None = None,
    bases: dict[str, DataFrame] | None = None,
    small_rows: int = SMALL_KEY_ROWS,
) -> dict[str, DataFrame]:
    """The nine dimensions; ``rows`` are measured base counts (small path),
    ``bases`` the frames they were measured on."""
    n = rows or {}
    bs = bases or {}

    def sized(name: str) -> dict:
        return {"rows": n.get(name), "base": bs.get(name), "small_rows": small_rows}

    pais_o, pais_d = D.dim_paises(bronze.paises, bronze.blocos_economicos, **sized("paises"))
    moeda_o, moeda_d = D.dim_moedas(bronze.moedas, **sized("moedas"))
    cat = D.dim_categoria_produto(spark, bronze.categoria_produtos, **sized("categoria"))
    return {
        "dim_tempo": D.dim_tempo(fx_clean, **sized("tempo")),
        "dim_pais_origem": pais_o,
        "dim_pais_destino": pais_d,
        "dim_categoria_produto": cat,
        "dim_produto": D.dim_produto(bronze.produtos, cat, transacoes_clean, **sized("produto")),
        "dim_moeda_origem": moeda_o,
        "dim_moeda_destino": moeda_d,
        "dim_tipo_transacao": D.dim_tipo_transacao(bronze.tipos_transacoes, **sized("tipo")),
        "dim_transporte": D.dim_transporte(bronze.transportes, **sized("transporte")),
    }


# dimension table -> its base in dimension_bases (row bound of its lookup)
_DIM_BASE = {
    "dim_tempo": "tempo",
    "dim_pais_origem": "paises",
    "dim_pais_destino": "paises",
    "dim_categoria_produto": "categoria",
    "dim_produto": "produto",
    "dim_moeda_origem": "moedas",
    "dim_moeda_destino": "moedas",
    "dim_tipo_transacao": "tipo",
    "dim_transporte": "transporte",
}


def build_star(
    spark: SparkSession,
    bronze: Bronze,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    small_key_rows: int = SMALL_KEY_ROWS,
    date_formats: list[str] | None = None,
    unknown_member: bool = False,
) -> Star:
    """Bronze -> cleaned tables -> nine dimensions -> numbered fact.

    Jobs: FX table, one job counting the FX table and every dimension
    base, then the fact (frequent keys of a large join, range sample, sorted table); large
    dimensions (above the measured small bound) add their own numbering.
    With ``unknown_member`` the category dimension holds an id-0 member, to which products
    without a known category fall back, so that their facts are kept.
    """
    ensure_checkpoint_dir(spark)
    fx = materialize(clean_cambios(bronze.cambios, date_formats), "fx_clean", WIDE_TABLE_CODEC)
    # bases stay lazy: measuring them in one job lets AQE coalesce their
    # shuffles (a persisted plan would keep every shuffle partition)
    # product ids need no duplicate removal of whole rows
    sold = valid_transactions(bronze.transacoes)
    bases = dimension_bases(spark, bronze, fx, sold, unknown_member)
    rows = count_rows({"fx": fx, **bases})
    # measured-small dimensions are numbered in one partition and kept in
    # memory by dense_key; larger ones go through a written table
    dims = build_dimensions(spark, bronze, fx, sold, rows, bases, small_key_rows)
    bounds = {name: rows[base] for name, base in _DIM_BASE.items()}
    keyed_fx = FT.key_fx(fx, dims, max_broadcast_rows, bounds)
    small, large = FT.key_lookups(dims, max_broadcast_rows, bounds, unknown_member)
    if fits_broadcast(keyed_fx, max_broadcast_rows, rows=rows["fx"]):
        small["cambio_id"] = F.broadcast(keyed_fx)
    else:
        large["cambio_id"] = keyed_fx
    observation, metrics = FT.audit_metrics()
    numbered = FT.number_fact(FT.join_large(bronze.transacoes, large), small, observe=(observation, metrics))
    return Star(
        **dims,
        fato_transacoes_internacionais=FT.fact_table(numbered),
        discard_audit=FT.discard_audit(numbered),
        quarantine=FT.quarantine(numbered),
        staged=numbered,
        audit_metrics=observation.get,
        rows={name: rows[base] for name, base in _DIM_BASE.items()},
        cached=taken_caches(),
    )


_PUBLISHED = "published"


def published(spark: SparkSession, wh_dir: str) -> list[tuple[int, str]]:
    """(version, folder below ``wh_dir``) of every published version, latest first."""
    path = f"{wh_dir.rstrip('/')}/{_PUBLISHED}"
    if not path_exists(spark, path):
        return []
    rows = spark.read.schema("version long, folder string").option("recursiveFileLookup", True).json(path).collect()
    return sorted(((r.version, r.folder) for r in rows), reverse=True)


def warehouse_folder(spark: SparkSession, wh_dir: str) -> str:
    """Folder of the tables that readers see now: the latest published version, or ``wh_dir`` itself if nothing was ever published there."""
    versions = published(spark, wh_dir)
    base = wh_dir.rstrip("/")
    return f"{base}/{versions[0][1]}" if versions else base


def write_star(star: Star, out_dir: str, mode: str = "overwrite", database: str | None = None, keep_versions: int = 2) -> str:
    """Write the star as a new version below ``out_dir`` and publish it; returns the version's folder.

    The nine dimensions (concurrently), then the fact, one Parquet folder per table, go to
    a folder of their own; then one small file names that version.  Readers
    follow the latest such file, so until it is there they see the old star
    whole, and a build that fails half-way is never seen.  Of two
    concurrent builds one publishes, the other fails.  The latest ``keep_versions`` versions
    stay, for readers that opened one before.  ``mode`` other than ``overwrite`` refuses a
    folder that holds a published star.

    With ``database`` the folders are also registered as catalog tables
    ``<database>.<table>`` (external tables over the same files), so later jobs
    can query the warehouse by name.
    """
    tables = star.tables()
    spark = tables[FACT].sparkSession
    base = out_dir.rstrip("/")
    before = published(spark, base)
    if before and mode != "overwrite":
        raise ValueError(f"{base} holds a published star")
    number = before[0][0] + 1 if before else 1
    folder = f"versions/{number:08d}-{uuid.uuid4().hex[:8]}"
    writer = parquet_writer(lambda n: f"{base}/{folder}/{n}", "errorifexists")
    write_all({n: df for n, df in tables.items() if n != FACT}, writer)
    write_all({FACT: tables[FACT]}, writer)
    # one row, one file: it is there whole or not at all
    spark.range(1).coalesce(1).select(F.lit(number).alias("version"), F.lit(folder).alias("folder")).write.mode("errorifexists").json(f"{base}/{_PUBLISHED}/{number:08d}")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.catalog.createTable(f"{database}.{name}", path=f"{base}/{folder}/{name}", source="parquet")
    for version, old in before[max(keep_versions, 1) - 1 :]:
        remove_path(spark, f"{base}/{_PUBLISHED}/{version:08d}")
        remove_path(spark, f"{base}/{old}")
    return f"{base}/{folder}"


def read_star(spark: SparkSession, wh_dir: str | None = None, database: str | None = None) -> Star:
    """The stored warehouse as a :class:`Star` (column-pruned Parquet scans),
    from its folder (the latest published version) or from the catalog tables of ``database``, with the
    measured row count of every dimension."""
    if database:
        tables = {name: spark.table(f"{database}.{name}") for name in DIMENSIONS + [FACT]}
    else:
        folder = warehouse_folder(spark, wh_dir)
        tables = {name: spark.read.parquet(f"{folder}/{name}") for name in DIMENSIONS + [FACT]}
    # dimension sizes for the marts' join strategy: one job, answered from
    # Parquet metadata
    rows = count_rows({name: tables[name] for name in DIMENSIONS})
    return Star(**tables, rows=rows)
