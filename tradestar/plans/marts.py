"""Analytical marts over the star (six BI views, thirteen queries).

Plan shape of every mart (``_measures``): when the dimension's measured row
count is within the broadcast bound, it is broadcast and the fact is
aggregated directly by the dimension attribute (few groups, so the partial
aggregate shuffles little); otherwise the fact is first aggregated by the
surrogate key and only that aggregate meets the dimension.  Either way the
fact itself is never shuffled to a join.  Top-N uses ``orderBy().limit()``
(``TakeOrderedAndProject``); shares are computed over the returned N rows.

Money sums are exact decimals (``decimal(38,2)``); averages and shares are
doubles computed as ``sum / count`` and ``value / total * 100``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradestar.functions import formatting as fmt
from tradestar.operators.keys import BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, most_bytes
from tradestar.plans.star import Star
from tradestar.session import materialize

SUM_TYPE = "decimal(38,2)"

# Display replacement of country names in the executive view.
DISPLAY_REPLACE = {"Emirados Arabes Unidos": "Emirados Arabes"}


def _by_key(fact: DataFrame, keys: list[str], with_qty: bool = False, with_rate: bool = False) -> DataFrame:
    aggs = [F.sum("valor_convertido_transacao").alias("_v"), F.count(F.lit(1)).alias("_n")]
    if with_qty:
        aggs.append(F.sum("quantidade_transacionada").alias("_q"))
    if with_rate:
        aggs.append(F.sum("taxa_cambio_transacao").alias("_r"))
    return fact.groupBy(*keys).agg(*aggs)


def _small(star: Star, dim: str, d: DataFrame) -> bool:
    """The dimension's measured row count is known, and so many rows of ``d`` are within the broadcast bounds."""
    rows = (star.rows or {}).get(dim)
    return rows is not None and rows <= DEFAULT_BROADCAST_ROWS and most_bytes(d, rows) <= BROADCAST_BYTES


def _measures(
    star: Star, dim: str, sk: str, attrs: list, with_qty: bool = False, with_rate: bool = False
) -> DataFrame:
    """Fact measures summed per dimension attribute(s): ``_v`` value, ``_n``
    rows, ``_q`` quantity, ``_r`` rate.

    A dimension of measured small size is broadcast and the fact aggregated
    directly by the attribute (map-side partial aggregate over few groups).
    Otherwise (large or unmeasured) the fact is first aggregated by the
    surrogate key, and only that aggregate meets the dimension, so the fact
    itself is never shuffled to a join.
    """
    d = getattr(star, dim).select(sk, *attrs)
    names = [c for c in d.columns if c != sk]
    if _small(star, dim, d):
        aggs = [F.sum("valor_convertido_transacao").alias("_v"), F.count(F.lit(1)).alias("_n")]
        if with_qty:
            aggs.append(F.sum("quantidade_transacionada").alias("_q"))
        if with_rate:
            aggs.append(F.sum("taxa_cambio_transacao").alias("_r"))
        return star.fact.join(F.broadcast(d), sk).groupBy(*names).agg(*aggs)
    aggs = [F.sum("_v").alias("_v"), F.sum("_n").alias("_n")]
    if with_qty:
        aggs.append(F.sum("_q").alias("_q"))
    if with_rate:
        aggs.append(F.sum("_r").alias("_r"))
    return _by_key(star.fact, [sk], with_qty, with_rate).join(d, sk).groupBy(*names).agg(*aggs)


def _money(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(SUM_TYPE)


def _mean(sum_col: str, n_col: str) -> Column:
    return F.try_divide(F.col(sum_col).cast("double"), F.col(n_col).cast("double"))


def _share(value: str) -> Column:
    total = F.sum(F.col(value)).over(Window.partitionBy())
    return F.col(value).cast("double") / total.cast("double") * 100


# --- view 1: value over time ---------------------------------------------


def monthly(star: Star) -> DataFrame:
    """ano, mes, valor_total (also the executive monthly series)."""
    m = _measures(star, "dim_tempo", "sk_tempo", ["ano", "mes"])
    return m.select("ano", "mes", _money("_v").alias("valor_total")).orderBy("ano", "mes")


def quarterly(star: Star) -> DataFrame:
    m = _measures(star, "dim_tempo", "sk_tempo", ["ano", "trimestre"])
    return m.select("ano", "trimestre", _money("_v").alias("valor_total")).orderBy("ano", "trimestre")


def annual(star: Star) -> DataFrame:
    m = _measures(star, "dim_tempo", "sk_tempo", ["ano"])
    return m.select("ano", _money("_v").alias("valor_total")).orderBy("ano")


def time_lattice(star: Star) -> DataFrame:
    """Every time total of the fact from one scan: by month, quarter, year, and all of it.

    Columns: nivel (mes, trimestre, ano, total), ano, trimestre, mes (null above their
    level), rotulo (``2024-03``, ``2024-T1``, ``2024``, ``total``), valor_total,
    quantidade_total, soma_taxas, transacoes.  The fact is aggregated by month, and the
    grouping sets run over those few rows.
    """
    months = _measures(star, "dim_tempo", "sk_tempo", ["ano", "trimestre", "mes"], with_qty=True, with_rate=True)
    keys = [F.col("ano"), F.col("trimestre"), F.col("mes")]
    totals = months.groupingSets([[], keys[:1], keys[:2], keys], *keys).agg(
        F.grouping_id().alias("_g"),
        _money(F.sum("_v")).alias("valor_total"),
        F.sum("_q").cast("bigint").alias("quantidade_total"),
        F.sum("_r").cast("decimal(38,4)").alias("soma_taxas"),
        F.sum("_n").cast("bigint").alias("transacoes"),
    )
    level = F.when(F.col("_g") == 0, "mes").when(F.col("_g") == 1, "trimestre").when(F.col("_g") == 3, "ano").otherwise("total")
    label = (
        F.when(F.col("_g") == 0, fmt.period_label(F.col("ano"), F.col("mes")))
        .when(F.col("_g") == 1, fmt.quarter_label(F.col("ano"), F.col("trimestre")))
        .when(F.col("_g") == 3, F.col("ano").cast("string"))
        .otherwise("total")
    )
    return totals.select(level.alias("nivel"), "ano", "trimestre", "mes", label.alias("rotulo"), "valor_total", "quantidade_total", "soma_taxas", "transacoes")


def _stored_lattice(star: Star) -> DataFrame:
    """The lattice as a small table, for several readers."""
    return materialize(time_lattice(star).coalesce(1), "lattice")


def temporal_view(star: Star, lattice: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three series of view 1 from one fact scan (their labels: :func:`view_labels`)."""
    found = _stored_lattice(star) if lattice is None else lattice
    series = {"mensal": ("mes", ["ano", "mes"]), "trimestral": ("trimestre", ["ano", "trimestre"]), "anual": ("ano", ["ano"])}
    return {name: found.filter(F.col("nivel") == level).select(*keys, "valor_total").orderBy(*keys) for name, (level, keys) in series.items()}


# --- view 2: countries ------------------------------------------------------


def _top_countries(star: Star, role: str, n: int) -> DataFrame:
    sk = f"sk_pais_{role}"
    m = _measures(star, f"dim_pais_{role}", sk, [F.col(f"nome_pais_{role}").alias("pais")])
    totals = m.select("pais", _money("_v").alias("valor_total"))
    top = totals.orderBy(F.desc("valor_total"), F.asc("pais")).limit(n)
    return top.select("pais", "valor_total", _share("valor_total").alias("participacao_pct"))


def top_origin_countries(star: Star, n: int = 10) -> DataFrame:
    return _top_countries(star, "origem", n)


def top_destination_countries(star: Star, n: int = 10) -> DataFrame:
    return _top_countries(star, "destino", n)


# --- view 3: economic blocs -------------------------------------------------


def blocs(star: Star) -> DataFrame:
    """Value by bloc, each transaction counted for its origin bloc and its
    destination bloc (twice inside one bloc); countries without a bloc out.

    One fact scan: both blocs are attached (broadcast when the country
    dimensions are measured small, else after aggregating the fact by the
    (origin, destination) pair), the pairs of blocs are aggregated, and only
    those few groups are unpivoted into the two roles.
    """
    o = star.dim_pais_origem.select("sk_pais_origem", F.col("bloco_economico_pais_origem").alias("_bo"))
    d = star.dim_pais_destino.select("sk_pais_destino", F.col("bloco_economico_pais_destino").alias("_bd"))
    if _small(star, "dim_pais_origem", o) and _small(star, "dim_pais_destino", d):
        f = star.fact.select("sk_pais_origem", "sk_pais_destino", F.col("valor_convertido_transacao").alias("_v"))
        roles = f.join(F.broadcast(o), "sk_pais_origem").join(F.broadcast(d), "sk_pais_destino")
    else:
        pairs = _by_key(star.fact, ["sk_pais_origem", "sk_pais_destino"])
        roles = pairs.join(o, "sk_pais_origem").join(d, "sk_pais_destino")
    roles = roles.groupBy("_bo", "_bd").agg(F.sum("_v").alias("_v"))
    both = roles.select(F.explode(F.array(F.struct(F.col("_bo").alias("bloco"), "_v"), F.struct(F.col("_bd").alias("bloco"), "_v"))).alias("r")).select("r.*")
    return (
        both.filter(F.col("bloco").isNotNull() & (F.col("bloco") != ""))
        .groupBy("bloco")
        .agg(_money(F.sum("_v")).alias("valor_total"))
        .orderBy(F.desc("valor_total"), F.asc("bloco"))
    )


def blocs_union(star: Star) -> DataFrame:
    """Same result as :func:`blocs`, written as the UNION ALL of both roles
    (two fact scans; kept for comparison in the bench)."""
    f = star.fact
    o = f.join(star.dim_pais_origem, "sk_pais_origem").select(
        F.col("bloco_economico_pais_origem").alias("bloco"), F.col("valor_convertido_transacao").alias("v")
    )
    d = f.join(star.dim_pais_destino, "sk_pais_destino").select(
        F.col("bloco_economico_pais_destino").alias("bloco"), F.col("valor_convertido_transacao").alias("v")
    )
    return (
        o.unionByName(d)
        .filter(F.col("bloco").isNotNull() & (F.col("bloco") != ""))
        .groupBy("bloco")
        .agg(_money(F.sum("v")).alias("valor_total"))
        .orderBy(F.desc("valor_total"), F.asc("bloco"))
    )


# --- view 4: products and categories ---------------------------------------


def top_products(star: Star, n: int = 10) -> DataFrame:
    """Top products by value (grouped by description); share of value among the N."""
    m = _measures(star, "dim_produto", "sk_produto", ["descricao_produto"], with_qty=True)
    totals = m.select("descricao_produto", F.col("_q").cast("bigint").alias("quantidade_total"), _money("_v").alias("valor_total"))
    top = totals.orderBy(F.desc("valor_total"), F.asc("descricao_produto")).limit(n)
    return top.select("descricao_produto", "quantidade_total", "valor_total", _share("valor_total").alias("participacao_pct"))


def categories(star: Star) -> DataFrame:
    """All categories by value; share of *quantity* over all categories."""
    m = _measures(star, "dim_categoria_produto", "sk_categoria_produto", ["descricao_categoria_produto"], with_qty=True)
    totals = m.select(
        "descricao_categoria_produto", F.col("_q").cast("bigint").alias("quantidade_total"), _money("_v").alias("valor_total")
    )
    return totals.select(
        "descricao_categoria_produto", "quantidade_total", "valor_total", _share("quantidade_total").alias("participacao_pct")
    ).orderBy(F.desc("valor_total"), F.asc("descricao_categoria_produto"))


# --- view 5: currencies -----------------------------------------------------


def top_currencies(star: Star, n: int = 10) -> DataFrame:
    """Top origin currencies by value with the mean rate of their rows."""
    m = _measures(star, "dim_moeda_origem", "sk_moeda_origem", [F.col("descricao_moeda_origem").alias("moeda")], with_rate=True)
    totals = m.select("moeda", "_r", "_n", _money("_v").alias("valor_total"))
    top = totals.orderBy(F.desc("valor_total"), F.asc("moeda")).limit(n)
    return top.select("moeda", _mean("_r", "_n").alias("taxa_media"), "valor_total")


def monthly_rate(star: Star) -> DataFrame:
    """ano, mes, mean rate, value."""
    m = _measures(star, "dim_tempo", "sk_tempo", ["ano", "mes"], with_rate=True)
    return m.select("ano", "mes", _mean("_r", "_n").alias("taxa_media"), _money("_v").alias("valor_total")).orderBy(
        "ano", "mes"
    )


# --- view 6: executive summary ---------------------------------------------


def kpis(star: Star, lattice: DataFrame | None = None) -> DataFrame:
    """One row always (count 0 and NULL sums on an empty fact)."""
    if lattice is not None:
        total = lattice.filter("nivel = 'total'").agg(*[F.max(c).alias(c) for c in ("valor_total", "quantidade_total", "transacoes")])
        return total.select("valor_total", "quantidade_total", _mean("valor_total", "transacoes").alias("ticket_medio"), F.coalesce("transacoes", F.lit(0).cast("bigint")).alias("total_transacoes"))
    f = star.fact
    return f.agg(
        _money(F.sum("valor_convertido_transacao")).alias("valor_total"),
        F.sum("quantidade_transacionada").cast("bigint").alias("quantidade_total"),
        F.try_divide(F.sum("valor_convertido_transacao").cast("double"), F.count(F.lit(1)).cast("double")).alias("ticket_medio"),
        F.count(F.lit(1)).alias("total_transacoes"),
    )


def _months(star: Star, lattice: DataFrame | None) -> DataFrame:
    """ano, mes and the monthly measures ``_v``, ``_q``, ``_n``."""
    if lattice is None:
        return _measures(star, "dim_tempo", "sk_tempo", ["ano", "mes"], with_qty=True)
    return lattice.filter("nivel = 'mes'").select("ano", "mes", F.col("valor_total").alias("_v"), F.col("quantidade_total").alias("_q"), F.col("transacoes").alias("_n"))


def executive_series(star: Star, lattice: DataFrame | None = None) -> DataFrame:
    """Monthly series with its first-of-month date (``periodo``)."""
    series = monthly(star) if lattice is None else _months(star, lattice).select("ano", "mes", _money("_v").alias("valor_total")).orderBy("ano", "mes")
    return series.select("ano", "mes", "valor_total", fmt.first_of_month(F.col("ano"), F.col("mes")).alias("periodo"))


def executive_top5(star: Star, n: int = 5, replace: dict[str, str] | None = None) -> DataFrame:
    """Top destination countries with display names; share among the N."""
    mapping = DISPLAY_REPLACE if replace is None else replace
    top = top_destination_countries(star, n)
    if mapping:
        top = top.replace(mapping, subset=["pais"])
    return top


def executive_rank_labels(star: Star, n: int = 5) -> DataFrame:
    """Top destination countries with the bar label ``1.234 (20.6%)``."""
    top = executive_top5(star, n)
    return top.select("pais", "valor_total", "participacao_pct", fmt.rank_label(F.col("valor_total"), F.col("participacao_pct")).alias("rotulo"))


def month_over_month(star: Star, lattice: DataFrame | None = None) -> DataFrame:
    """Last month present vs the previous month present (one row).

    ``variacao_pct`` is 0 with fewer than two months or a zero previous
    value; ``ultimo_valor`` is 0 on an empty fact.
    """
    m = monthly(star) if lattice is None else _months(star, lattice).select("ano", "mes", _money("_v").alias("valor_total"))
    ranked = m.withColumn("_prev", F.lag("valor_total").over(Window.orderBy("ano", "mes")))
    last = ranked.agg(
        F.max_by(F.struct("ano", "mes", "valor_total", "_prev"), F.struct("ano", "mes")).alias("_u")
    ).select("_u.*")
    cur = F.col("valor_total").cast("double")
    prev = F.col("_prev").cast("double")
    change = F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise((cur - prev) / prev * 100)
    return last.select(
        "ano",
        "mes",
        F.coalesce(cur, F.lit(0.0)).alias("ultimo_valor"),
        prev.alias("valor_anterior"),
        change.alias("variacao_pct"),
    )


def period_labels(star: Star) -> DataFrame:
    """Monthly series with its labels: ``YYYY-MM``, ``YYYY-Tq``, year text, date."""
    m = _measures(star, "dim_tempo", "sk_tempo", ["ano", "mes", "trimestre"]).select(
        "ano", "mes", "trimestre", _money("_v").alias("valor_total")
    )
    return m.select(
        "ano",
        "mes",
        fmt.period_label(F.col("ano"), F.col("mes")).alias("periodo_label"),
        fmt.quarter_label(F.col("ano"), F.col("trimestre")).alias("trimestre_label"),
        F.col("ano").cast("string").alias("ano_label"),
        fmt.first_of_month(F.col("ano"), F.col("mes")).alias("periodo"),
        "valor_total",
    ).orderBy("ano", "mes")


def executive_cards(star: Star, lattice: DataFrame | None = None) -> DataFrame:
    """Text of the four KPI cards and of the last-month box (one row).

    Everything comes from one monthly aggregate (tiny): totals are sums of
    months, the last month and its predecessor come from a lag over months.
    The mean ticket is rounded half-up to cents in decimal arithmetic.
    """
    months = _months(star, lattice).withColumn("_prev", F.lag("_v").over(Window.orderBy("ano", "mes")))
    row = months.agg(
        _money(F.sum("_v")).alias("_vt"),
        F.coalesce(F.sum("_q"), F.lit(0)).alias("_qt"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_nt"),
        F.max_by(F.struct("_v", "_prev"), F.struct("ano", "mes")).alias("_u"),
    )
    # half-up to cents in whole decimal numbers: no double, no bigint
    twice = (F.col("_vt") * 200).cast("decimal(38,0)") + F.col("_nt")
    ticket = F.when(F.col("_nt") > 0, F.expr("_twice - _twice % (2 * _nt)") / (F.col("_nt") * 2))
    row = row.withColumn("_twice", twice.cast("decimal(38,0)")).withColumn("_ticket", (ticket.cast("decimal(38,0)") / 100).cast("decimal(38,2)"))
    cur = F.coalesce(F.col("_u._v"), F.lit(0)).cast(SUM_TYPE)
    prev = F.col("_u._prev").cast("double")
    change = F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise((cur.cast("double") - prev) / prev * 100)
    return row.select(
        fmt.money_text(F.coalesce(F.col("_vt"), F.lit(0).cast(SUM_TYPE))).alias("valor_total_txt"),
        fmt.thousands(F.col("_qt")).alias("quantidade_total_txt"),
        fmt.money_text(F.coalesce("_ticket", F.lit(0).cast(SUM_TYPE))).alias("ticket_medio_txt"),
        fmt.thousands(F.col("_nt")).alias("total_transacoes_txt"),
        fmt.money_text(cur).alias("ultimo_mes_txt"),
        fmt.signed_pct(change).alias("variacao_txt"),
    )


# --- the six BI views ------------------------------------------------------

VIEWS = {
    1: "evolucao financeira no tempo",
    2: "paises que mais movimentam",
    3: "blocos economicos",
    4: "produtos e categorias",
    5: "impacto cambial",
    6: "visao executiva",
}


def view(star: Star, number: int) -> dict[str, DataFrame]:
    """The result frames behind BI view ``number`` (1-6), by name."""
    if number == 1:
        return temporal_view(star)
    if number == 2:
        return {"origem": top_origin_countries(star), "destino": top_destination_countries(star)}
    if number == 3:
        return {"blocos": blocs(star)}
    if number == 4:
        return {"produtos": top_products(star), "categorias": categories(star)}
    if number == 5:
        return {"moedas": top_currencies(star), "mensal": monthly_rate(star)}
    if number == 6:
        # one fact scan for everything by time, one more for the countries
        lattice = _stored_lattice(star)
        return {
            "kpis": kpis(star, lattice),
            "serie": executive_series(star, lattice),
            "top5": executive_top5(star),
            "variacao": month_over_month(star, lattice),
            "cartoes": executive_cards(star, lattice),
        }
    raise ValueError(f"view must be 1-6, got {number}")


def view_labels(star: Star, number: int) -> DataFrame:
    """The text labels of BI view 1 (month, quarter, year), 5 (month) or 6 (countries), each beside its value."""
    if number == 1:
        return time_lattice(star).filter("nivel <> 'total'").select("nivel", "rotulo", "valor_total").orderBy("nivel", "rotulo")
    if number == 5:
        return monthly_rate(star).select(fmt.period_label(F.col("ano"), F.col("mes")).alias("rotulo"), "taxa_media", "valor_total")
    if number == 6:
        return executive_rank_labels(star)
    raise ValueError(f"view {number} has no labels")
