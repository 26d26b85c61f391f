"""The fact table: FX join, currency conversion, surrogate-key lookups,
discard audit and dense numbering.

All lookups are left joins that keep the transaction and record *why* a row
cannot enter the fact (``motivo``); the first missing item in a fixed order
is the reason.  The staged rows (kept and rejected) are materialised once,
by the numbering step, so the fact, the quarantine and the audit all read
the same stored table (column-pruned) instead of recomputing the joins; what
follows from one stored row (:func:`measures`) is not stored.

Join strategy: the FX table and every dimension lookup are broadcast only
after their row count is measured (:func:`fits_broadcast`), and only after the
shuffle of the numbering, so their columns are not shuffled with the rows.  Larger sides are
joined before it, the FX table last.  The duplicate removal brings the rows
together by the key of the first of these joins, which then needs no shuffle of them
(:func:`join_large`); transactions of a frequent key go another way, by broadcast.  In
later joins AQE splits partitions of a hot ``cambio_id`` / product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradestar.functions.coerce import round_to_int
from tradestar.operators.clean import clean_transacoes
from tradestar.operators.keys import DEFAULT_BROADCAST_ROWS, HOT_SHARE, bounded_broadcast, dense_key, fits_broadcast, frequent_values, lookup_frame
from tradestar.schemas import MONEY, RATE, WAREHOUSE

# Discard reasons, in the order they are checked.
REASON_FX = "cambio_ausente_ou_invalido"
REASON_KEYS = [
    "sk_tempo",
    "sk_moeda_origem",
    "sk_moeda_destino",
    "sk_produto",
    "sk_categoria_produto",
    "sk_pais_origem",
    "sk_pais_destino",
    "sk_tipo_transacao",
    "sk_transporte",
]
REASON_RANGE = "valor_fora_da_faixa"
REASONS = [REASON_FX] + [f"sem_{k}" for k in REASON_KEYS] + [REASON_RANGE]

# Total order of the fact rows (numbering of sk_transacao).
FACT_ORDER = [
    "id_transacao",
    "cambio_id",
    "tipo_id",
    "pais_origem",
    "pais_destino",
    "produto_id",
    "transporte_id",
    "valor_monetario_transacao",
    "quantidade_transacionada",
]


def transaction_rows(transacoes_clean: DataFrame) -> DataFrame:
    """Cleaned transactions under the names of the staged rows."""
    return transacoes_clean.select(
        F.col("id").alias("id_transacao"),
        "tipo_id",
        "pais_origem",
        "pais_destino",
        "produto_id",
        F.col("valor_monetario").alias("valor_monetario_transacao"),
        F.col("quantidade").alias("quantidade_transacionada"),
        "transporte_id",
        "cambio_id",
    )


def join_large(transacoes: DataFrame, lookups: dict[str, DataFrame], share: float = HOT_SHARE) -> DataFrame:
    """Cleaned transactions left-joined with lookups that are too large to broadcast, by key column.

    The duplicate removal shuffles the raw rows by the first key, and the join uses that
    shuffle.  Rows whose key at least ``share`` of all have are cleaned apart, with
    map-side combine, and meet the few rows of the lookup that hold such keys by broadcast, so no
    task gets more than that share of the rows for one key, copies included.
    """
    if not lookups:
        return transaction_rows(clean_transacoes(transacoes))
    (key, lookup), *others = lookups.items()
    hot = F.col(key).isin(frequent_values(transacoes, key, share))
    # at most 1 / share rows
    found = F.broadcast(lookup.filter(hot))
    rest = transaction_rows(clean_transacoes(transacoes.filter(~hot), near=key)).join(lookup, key, "left")
    joined = rest.unionByName(transaction_rows(clean_transacoes(transacoes.filter(hot))).join(found, key, "left"))
    for other, frame in others:
        joined = joined.join(frame, other, "left")
    return joined


def key_fx(fx_clean: DataFrame, dims: dict[str, DataFrame], max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, bounds: dict[str, int] | None = None) -> DataFrame:
    """The FX table with the keys that depend on it alone: time and both currencies.

    Attached once per FX row, not once per transaction, and a transaction without
    an FX row has no NULL key to look up.
    """
    b = bounds or {}
    keyed = fx_clean
    for dim, natural, sk, column in (
        ("dim_tempo", "data", "sk_tempo", "data"),
        ("dim_moeda_origem", "id_moeda_origem", "sk_moeda_origem", "moeda_origem"),
        ("dim_moeda_destino", "id_moeda_destino", "sk_moeda_destino", "moeda_destino"),
    ):
        keyed = keyed.join(bounded_broadcast(lookup_frame(dims[dim], natural, sk, column), max_broadcast_rows, rows=b.get(dim)), column, "left")
    return keyed.select(F.col("id").alias("cambio_id"), "data", "moeda_origem", "moeda_destino", "taxa_cambio", "sk_tempo", "sk_moeda_origem", "sk_moeda_destino")


def key_lookups(
    dims: dict[str, DataFrame],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    bounds: dict[str, int] | None = None,
    unknown_member: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Slim ``natural key -> sk`` frames of the transaction's own keys, by key column: those to broadcast and the larger ones.

    ``bounds`` are measured row counts of the dimensions (a lookup has at
    most as many rows as its dimension); a dimension without a bound is
    counted.  The product lookup also carries the category key (product ->
    category id -> category sk), so two fact keys cost one join.  With
    ``unknown_member`` a category id that the dimension does not hold falls back
    to its id-0 member.
    """
    b = bounds or {}
    cat = lookup_frame(dims["dim_categoria_produto"], "id_categoria_produto", "sk_categoria_produto")
    prod = lookup_frame(dims["dim_produto"], "id_produto", "sk_produto", extra=["id_categoria_produto"])
    prod = prod.join(cat, "id_categoria_produto", "left")
    if unknown_member:
        unknown = cat.filter(F.col("id_categoria_produto") == 0).select(F.col("sk_categoria_produto").alias("_unknown"))
        # one row: the id-0 member
        prod = prod.join(F.broadcast(unknown), F.lit(True), "left").withColumn("sk_categoria_produto", F.coalesce("sk_categoria_produto", "_unknown"))
    prod = prod.select(F.col("id_produto").alias("produto_id"), "sk_produto", "sk_categoria_produto")
    frames = {
        "pais_origem": (lookup_frame(dims["dim_pais_origem"], "id_pais_origem", "sk_pais_origem", "pais_origem"), "dim_pais_origem"),
        "pais_destino": (lookup_frame(dims["dim_pais_destino"], "id_pais_destino", "sk_pais_destino", "pais_destino"), "dim_pais_destino"),
        "produto_id": (prod, "dim_produto"),
        "tipo_id": (lookup_frame(dims["dim_tipo_transacao"], "id_tipo_transacao", "sk_tipo_transacao", "tipo_id"), "dim_tipo_transacao"),
        "transporte_id": (lookup_frame(dims["dim_transporte"], "id_transporte", "sk_transporte", "transporte_id"), "dim_transporte"),
    }
    small = {k: fits_broadcast(df, max_broadcast_rows, rows=b.get(dim)) for k, (df, dim) in frames.items()}
    return {k: F.broadcast(df) for k, (df, _) in frames.items() if small[k]}, {k: df for k, (df, _) in frames.items() if not small[k]}


def measures(rows: DataFrame) -> DataFrame:
    """What follows from a joined row alone: the converted value ``valor x taxa`` (exact decimal
    product, unrounded rate), whether it has an FX row, and the measures in storage types."""
    found = rows.withColumn("valor_convertido", F.col("valor_monetario_transacao") * F.col("taxa_cambio"))
    return found.select(
        "*",
        (F.col("data").isNotNull() & F.col("taxa_cambio").isNotNull()).alias("_fx_ok"),
        round_to_int(F.col("quantidade_transacionada")).alias("_qty"),
        F.col("valor_monetario_transacao").try_cast(MONEY).alias("_value"),
        F.col("valor_convertido").try_cast(MONEY).alias("_converted"),
        F.col("taxa_cambio").try_cast(RATE).alias("_rate"),
    )


# Columns of :func:`measures`.
MEASURES = ["valor_convertido", "_fx_ok", "_qty", "_value", "_converted", "_rate"]


def stage_fact(joined: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Every cleaned transaction (joined with its large lookups) with its nine keys and
    ``motivo`` (NULL when the row belongs in the fact)."""
    staged = joined
    for key, lookup in lookups.items():
        staged = staged.join(lookup, key, "left")

    staged = measures(staged)
    reason = F.when(~F.col("_fx_ok"), F.lit(REASON_FX))
    for k in REASON_KEYS:
        reason = reason.when(F.col(k).isNull(), F.lit(f"sem_{k}"))
    in_range = (
        F.col("_qty").isNotNull() & F.col("_value").isNotNull() & F.col("_converted").isNotNull() & F.col("_rate").isNotNull()
    )
    reason = reason.when(~in_range, F.lit(REASON_RANGE))
    return staged.withColumn("motivo", reason).drop(*MEASURES)


def audit_metrics() -> tuple[Observation, list]:
    """Job metrics of the staged rows: rows in, rows kept and rows lost per
    reason, collected while the staged table is written (no extra pass)."""
    metrics = [F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("motivo").isNull()).alias("fato")]
    metrics += [F.count_if(F.col("motivo") == F.lit(r)).alias(r) for r in REASONS]
    return Observation("discard_audit"), metrics


def number_fact(joined: DataFrame, lookups: dict[str, DataFrame], observe: tuple[Observation, list] | None = None) -> DataFrame:
    """Run the staging once; number the kept rows 1..n.

    ``lookups`` are those to broadcast: they meet the rows behind the range shuffle.
    Returns the staged rows with ``sk_transacao`` (NULL for rejected rows),
    read from a Parquet table in the checkpoint folder that was written
    range-partitioned and sorted by the fact order, so the fact files come
    out clustered by ``id_transacao``.
    """
    numbered = dense_key(joined, FACT_ORDER, "sk_transacao", keep=F.col("motivo").isNull(), observe=observe, then=lambda rows: stage_fact(rows, lookups))
    return measures(numbered)


def fact_table(numbered: DataFrame) -> DataFrame:
    """The stored fact: fixed column order and storage types."""
    kept = numbered.filter(F.col("motivo").isNull())
    cols = {
        "sk_transacao": F.col("sk_transacao"),
        "id_transacao": F.col("id_transacao"),
        "quantidade_transacionada": F.col("_qty"),
        "valor_monetario_transacao": F.col("_value"),
        "valor_convertido_transacao": F.col("_converted"),
        "taxa_cambio_transacao": F.col("_rate"),
        "custo_transporte_transacao": F.lit(0).cast(MONEY),
    }
    for k in REASON_KEYS:
        cols[k] = F.col(k)
    schema = WAREHOUSE["fato_transacoes_internacionais"]
    return kept.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def quarantine(numbered: DataFrame) -> DataFrame:
    """Rejected transactions with their reason (source values, typed)."""
    return numbered.filter(F.col("motivo").isNotNull()).select(
        "motivo",
        "id_transacao",
        "tipo_id",
        "pais_origem",
        "pais_destino",
        "produto_id",
        "valor_monetario_transacao",
        "quantidade_transacionada",
        "transporte_id",
        "cambio_id",
    )


def discard_audit(numbered: DataFrame) -> DataFrame:
    """Rows lost per reason (only reasons that occurred)."""
    return (
        numbered.filter(F.col("motivo").isNotNull())
        .groupBy("motivo")
        .agg(F.count(F.lit(1)).alias("transacoes"))
    )
