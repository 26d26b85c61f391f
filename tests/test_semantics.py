"""Golden tests on hand-made bronze tables: one per tricky rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tradestar.operators.clean import clean_cambios, clean_transacoes
from tradestar.plans import marts as M
from tradestar.plans.star import build_star
from tradestar.schemas import raw_schema
from tradestar.sources.bronze import standardize_bronze

BASE = {
    "blocos_economicos": [("1", "MERCOSUL"), ("2", "UNIAO EUROPEIA")],
    "paises": [
        ("1", "Brasil", "BRA", "1.0"),
        ("2", "Alemanha", "DEU", "2.0"),
        ("3", "Emirados Árabes Unidos", "ARE", None),
        ("4", "Emirados Arabes Unidos", "EAU", None),
    ],
    "moedas": [("1", "Real", "Brasil"), ("2", "Euro", "Zona do Euro")],
    "tipos_transacoes": [("1", "EXPORTACAO"), ("2", "IMPORTACAO")],
    "transportes": [("1", "MARITIMO"), ("2", "AEREO")],
    "categoria_produtos": [("1", "ALIMENTOS"), ("2", "ELETRONICOS")],
    "produtos": [("1", "Cafe", "1", "09011110"), ("2", "TV", "2", "85287200"), ("3", "Sem categoria", None, "00000001")],
    "cambios": [
        ("10", "2024-01-01", "1", "2", "0.5"),
        ("11", "2024-02-15 10:30:00", "2", "1", "2.0"),
        ("12", "invalida", "1", "2", "1.0"),
        ("13", "2024-03-01", "1", "2", "0"),
        ("14", "2024-03-05", "1", "2", "abc"),
        ("15", "2024-01-10", "1", "2", "x"),  # invalid first row ...
        ("15", "2024-04-01", "1", "2", "1.5"),  # ... so the later valid one is kept
        ("16", "2024-04-02", "1", "2", "1.25"),
        ("16", "2024-05-02", "1", "2", "9"),  # later date: not kept
    ],
    "transacoes": [
        ("1", "1", "1", "2", "1", "100.00", "10", "1", "10"),
        ("1", "1", "1", "2", "1", "100.00", "10", "1", "10"),  # exact duplicate
        ("2", "2", "2", "1", "2", "200.50", "2.5", "2", "11"),  # quantity rounds half up
        ("3", "1", "1", "3", "1", "x", "1", "1", "10"),  # invalid value
        ("4", "1", "1", "2", "1", "-1.00", "1", "1", "10"),  # value <= 0
        ("5", "1", "1", "2", "1", "10", "0", "1", "10"),  # quantity <= 0
        ("6", "1", "1", "2", "1", "10", None, "1", "10"),  # missing field
        ("7", "1", "1", "2", "1", "NaN", "1", "1", "10"),  # NaN is not a number here
        ("8", "1", "1", "2", "1", " 30 ", "1", "1", "12"),  # FX with invalid date
        ("9", "1", "1", "2", "1", "30", "1", "1", "99"),  # unknown FX
        ("10", "1", "1", "2", "3", "50", "1", "1", "15"),  # product without category
        ("11", "1", "2", "4", "2", "40", "4", "1", "16"),
        ("12", "1", "1", "2", "77", "40", "4", "1", "16"),  # unknown product
    ],
}


def make_bronze(spark, overrides=None, drop=()):
    tables = dict(BASE)
    tables.update(overrides or {})
    frames = {}
    for name, rows in tables.items():
        frames[name] = None if name in drop else spark.createDataFrame(rows, raw_schema(name))
    for name in drop:
        frames[name] = None
    return standardize_bronze(frames)


@pytest.fixture(scope="module")
def star(spark):
    return build_star(spark, make_bronze(spark))


def test_clean_transacoes_rules(spark):
    out = {r["id"]: r for r in clean_transacoes(make_bronze(spark).transacoes).collect()}
    assert sorted(out) == [1, 2, 8, 9, 10, 11, 12]
    assert out[8]["valor_monetario"] == Decimal("30.0000")  # blanks ignored
    assert out[2]["quantidade"] == Decimal("2.5000")


def test_fx_keep_first_valid(spark):
    fx = {r["id"]: r for r in clean_cambios(make_bronze(spark).cambios).collect()}
    assert sorted(fx) == [10, 11, 15, 16]
    assert fx[15]["taxa_cambio"] == Decimal("1.50000000")
    assert fx[16]["data"] == dt.datetime(2024, 4, 2)
    assert fx[11]["data"] == dt.datetime(2024, 2, 15, 10, 30)


def test_fx_date_formats(spark):
    rows = [("1", "02/01/2024", "1", "2", "0.5"), ("2", "2024-01-03", "1", "2", "0.5"), ("3", "2024/13/45", "1", "2", "1")]
    c = make_bronze(spark, {"cambios": rows}).cambios
    iso_only = {r["id"]: r["data"] for r in clean_cambios(c).collect()}
    assert iso_only == {2: dt.datetime(2024, 1, 3)}
    extra = {r["id"]: r["data"] for r in clean_cambios(c, ["dd/MM/yyyy"]).collect()}
    assert extra == {1: dt.datetime(2024, 1, 2), 2: dt.datetime(2024, 1, 3)}


def test_fact_rows_and_values(star):
    f = {r["id_transacao"]: r for r in star.fact.collect()}
    assert sorted(f) == [1, 2, 11]
    assert f[1]["valor_convertido_transacao"] == Decimal("50.00")
    assert f[2]["quantidade_transacionada"] == 3
    assert f[2]["valor_convertido_transacao"] == Decimal("401.00")
    assert f[11]["taxa_cambio_transacao"] == Decimal("1.2500")
    assert f[1]["custo_transporte_transacao"] == Decimal("0.00")
    assert sorted(r["sk_transacao"] for r in f.values()) == [1, 2, 3]


def test_discard_audit(star):
    audit = {r["motivo"]: r["transacoes"] for r in star.discard_audit.collect()}
    assert audit == {"cambio_ausente_ou_invalido": 2, "sem_sk_produto": 1, "sem_sk_categoria_produto": 1}
    # the same numbers, observed while the staged rows were written
    observed = {k: v for k, v in star.audit_metrics.items() if v and k not in ("linhas", "fato")}
    assert observed == audit
    assert star.audit_metrics["linhas"] == 7 and star.audit_metrics["fato"] == 3


def test_time_dimension(star):
    rows = {r["data_referencia"]: r for r in star.dim_tempo.collect()}
    jan = rows[dt.date(2024, 1, 1)]
    assert (jan["ano"], jan["mes"], jan["dia"], jan["trimestre"], jan["semestre"]) == (2024, 1, 1, 1, 1)
    assert jan["nome_do_mes"] == "JANEIRO"
    assert jan["dia_da_semana"] == "SEGUNDA-FEIRA"  # weekday 0 is Monday
    assert rows[dt.date(2024, 4, 2)]["dia_da_semana"] == "TERCA-FEIRA"
    assert sorted(r["sk_tempo"] for r in rows.values()) == list(range(1, len(rows) + 1))


def test_country_dimension(star):
    rows = {r["id_pais_origem"]: r for r in star.dim_pais_origem.collect()}
    assert rows[1]["bloco_economico_pais_origem"] == "MERCOSUL"  # "1.0" joins bloc 1
    assert rows[3]["bloco_economico_pais_origem"] is None


def test_product_dimension(star):
    rows = {r["id_produto"]: r for r in star.dim_produto.collect()}
    assert rows[1]["codigo_ncm_produto"] == 9011110
    assert rows[1]["codigo_ncm"] == "09011110"
    assert rows[3]["id_categoria_produto"] == 0
    assert rows[3]["categoria_produto"] == "SEM_CATEGORIA"


@pytest.mark.parametrize(
    "drop,expected_ids",
    [
        ((), [1, 2, 11]),  # both files: category must exist
        (("categoria_produtos",), [10]),  # products only: only category 0 / missing survives
        (("produtos",), []),  # categories only: every product is category 0, unknown
        (("produtos", "categoria_produtos"), [1, 2, 10, 11, 12]),  # neither: all kept
    ],
)
def test_category_matrix(spark, drop, expected_ids):
    s = build_star(spark, make_bronze(spark, drop=drop))
    assert sorted(r["id_transacao"] for r in s.fact.collect()) == expected_ids


def test_product_fallback_names(spark):
    s = build_star(spark, make_bronze(spark, drop=("produtos",)))
    names = {r["id_produto"]: r["descricao_produto"] for r in s.dim_produto.collect()}
    assert names[77] == "PRODUTO 77"
    assert all(r["codigo_ncm_produto"] is None for r in s.dim_produto.collect())


def test_marts_on_golden(star):
    kpi = M.kpis(star).collect()[0]
    assert kpi["total_transacoes"] == 3
    assert kpi["valor_total"] == Decimal("501.00")
    assert kpi["quantidade_total"] == 17
    blocs = {r["bloco"]: r["valor_total"] for r in M.blocs(star).collect()}
    # fact 1 (50): BRA->DEU, fact 2 (401): DEU->BRA, fact 11 (50): DEU->country without bloc
    assert blocs == {"MERCOSUL": Decimal("451.00"), "UNIAO EUROPEIA": Decimal("501.00")}
    assert blocs == {r["bloco"]: r["valor_total"] for r in M.blocs_union(star).collect()}


def test_display_replace_is_exact(star):
    top = {r["pais"] for r in M.executive_top5(star).collect()}
    assert "Emirados Arabes" in top  # unaccented name replaced
    assert "Emirados Árabes Unidos" not in top  # accented name is not in the fact


def test_top_n_tie_break_by_name(spark):
    rows = BASE["transacoes"][:1] + [("20", "1", "1", "1", "1", "100.00", "10", "1", "10")]
    s = build_star(spark, make_bronze(spark, {"transacoes": rows}))
    top = M.top_destination_countries(s, n=1).collect()
    assert [r["pais"] for r in top] == ["Alemanha"]  # tie on value, first by name


def test_month_over_month(star):
    mom = M.month_over_month(star).collect()[0]
    assert (mom["ano"], mom["mes"]) == (2024, 4)
    assert mom["ultimo_valor"] == 50.0
    assert mom["variacao_pct"] == pytest.approx((50.0 - 401.0) / 401.0 * 100)


def test_empty_fact(spark):
    s = build_star(spark, make_bronze(spark, {"transacoes": [("1", "1", "1", "2", "1", "x", "1", "1", "10")]}))
    kpi = M.kpis(s).collect()
    assert len(kpi) == 1 and kpi[0]["total_transacoes"] == 0 and kpi[0]["valor_total"] is None
    mom = M.month_over_month(s).collect()
    assert len(mom) == 1 and mom[0]["variacao_pct"] == 0.0 and mom[0]["ultimo_valor"] == 0.0
    cards = M.executive_cards(s).collect()[0]
    assert cards["total_transacoes_txt"] == "0"


def test_empty_tables_keep_their_schema(spark, tmp_path):
    from tradestar.plans.star import read_star, write_star

    s = build_star(spark, make_bronze(spark, {"transacoes": [("1", "1", "1", "2", "1", "x", "1", "1", "10")]}))
    write_star(s, str(tmp_path / "wh"))
    wh = read_star(spark, str(tmp_path / "wh"))
    assert wh.fact.count() == 0
    assert wh.fact.columns == s.tables()["fato_transacoes_internacionais"].columns


def test_single_month_change_is_zero(spark):
    rows = [BASE["transacoes"][0]]
    s = build_star(spark, make_bronze(spark, {"transacoes": rows}))
    assert M.month_over_month(s).collect()[0]["variacao_pct"] == 0.0


def test_duplicate_business_id_does_not_fan_out(spark):
    moedas = BASE["moedas"] + [("1", "Real antigo", "Brasil")]
    s = build_star(spark, make_bronze(spark, {"moedas": moedas}))
    assert s.fact.count() == 3
    from tradestar.operators import quality as Q

    dup = {r["check_name"]: r["violations"] for r in Q.check_unique(s.tables()).collect() if r["table_name"] == "dim_moeda_origem"}
    assert dup["business_key:id_moeda_origem"] == 1


def test_formatting(star):
    cards = M.executive_cards(star).collect()[0]
    assert cards["valor_total_txt"] == "R$ 501,00"
    assert cards["ticket_medio_txt"] == "R$ 167,00"
    assert cards["variacao_txt"].startswith("-87.5")
    labels = M.period_labels(star).collect()
    assert labels[0]["periodo_label"] == "2024-01" and labels[0]["trimestre_label"] == "2024-T1"
    assert labels[0]["periodo"] == dt.date(2024, 1, 1)
