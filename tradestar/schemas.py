"""Schemas of the bronze layer and of the warehouse (star schema).

Bronze tables are read with an explicit all-string schema and coerced in
the cleaning step, so a malformed value becomes NULL instead of failing the
read or changing the inferred type of a whole column.  Warehouse tables
carry the fixed types of the star model; money is ``decimal(15,2)`` and the
rate ``decimal(10,4)`` for storage only.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- bronze layer --------------------------------------------------------

# The table and column names, text lengths and decimal sizes of this
# module are those of the source tables and the warehouse.
BRONZE_COLUMNS: dict[str, list[str]] = {
    "transacoes": [
        "id",
        "tipo_id",
        "pais_origem",
        "pais_destino",
        "produto_id",
        "valor_monetario",
        "quantidade",
        "transporte_id",
        "cambio_id",
    ],
    "cambios": ["id", "data", "moeda_origem", "moeda_destino", "taxa_cambio"],
    "paises": ["id", "nome", "codigo_iso", "bloco_id"],
    "blocos_economicos": ["id", "nome"],
    "moedas": ["id", "descricao", "pais"],
    "tipos_transacoes": ["id", "descricao"],
    "transportes": ["id", "descricao"],
    "produtos": ["id", "descricao", "categoria_id", "codigo_ncm"],
    "categoria_produtos": ["id", "descricao"],
}

REQUIRED_TABLES = ["transacoes", "paises", "moedas", "cambios", "tipos_transacoes", "transportes", "blocos_economicos"]
OPTIONAL_TABLES = ["produtos", "categoria_produtos"]

# Integer-valued columns of each bronze table (coerced from text).
BRONZE_INT_COLUMNS: dict[str, list[str]] = {
    "transacoes": ["id", "tipo_id", "pais_origem", "pais_destino", "produto_id", "transporte_id", "cambio_id"],
    "cambios": ["id", "moeda_origem", "moeda_destino"],
    "paises": ["id", "bloco_id"],
    "blocos_economicos": ["id"],
    "moedas": ["id"],
    "tipos_transacoes": ["id"],
    "transportes": ["id"],
    "produtos": ["id", "categoria_id"],
    "categoria_produtos": ["id"],
}


def raw_schema(table: str, columns: list[str] | None = None) -> T.StructType:
    """All-string schema of a bronze table (the CSV read schema)."""
    cols = columns or BRONZE_COLUMNS[table]
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


# --- staging types --------------------------------------------------------

VALUE_STAGE = T.DecimalType(19, 4)  # transaction value while in flight
QTY_STAGE = T.DecimalType(20, 4)  # quantity while in flight (accepts "1.0")
RATE_STAGE = T.DecimalType(18, 8)  # FX rate while in flight (unrounded)
MONEY = T.DecimalType(15, 2)  # stored money
RATE = T.DecimalType(10, 4)  # stored rate

# --- warehouse (star) ------------------------------------------------------


def _f(name: str, dtype: T.DataType, nullable: bool = False) -> T.StructField:
    return T.StructField(name, dtype, nullable)


_I = T.IntegerType()
_L = T.LongType()  # keys: dense surrogate keys and business ids outgrow INT at scale
_S = T.StringType()

WAREHOUSE: dict[str, T.StructType] = {
    "dim_tempo": T.StructType(
        [
            _f("sk_tempo", _L),
            _f("data_referencia", T.DateType()),
            _f("ano", _I),
            _f("mes", _I),
            _f("dia", _I),
            _f("trimestre", _I),
            _f("semestre", _I),
            _f("nome_do_mes", _S),
            _f("dia_da_semana", _S),
        ]
    ),
    "dim_pais_origem": T.StructType(
        [
            _f("sk_pais_origem", _L),
            _f("id_pais_origem", _L),
            _f("nome_pais_origem", _S),
            _f("codigo_iso_pais_origem", _S),
            _f("bloco_economico_pais_origem", _S, True),
        ]
    ),
    "dim_pais_destino": T.StructType(
        [
            _f("sk_pais_destino", _L),
            _f("id_pais_destino", _L),
            _f("nome_pais_destino", _S),
            _f("codigo_iso_pais_destino", _S),
            _f("bloco_economico_pais_destino", _S, True),
        ]
    ),
    "dim_produto": T.StructType(
        [
            _f("sk_produto", _L),
            _f("id_produto", _L),
            _f("descricao_produto", _S),
            _f("codigo_ncm_produto", _I, True),
        ]
    ),
    "dim_categoria_produto": T.StructType(
        [
            _f("sk_categoria_produto", _L),
            _f("id_categoria_produto", _L),
            _f("descricao_categoria_produto", _S),
        ]
    ),
    "dim_moeda_origem": T.StructType(
        [
            _f("sk_moeda_origem", _L),
            _f("id_moeda_origem", _L),
            _f("descricao_moeda_origem", _S),
            _f("pais_moeda_origem", _S),
        ]
    ),
    "dim_moeda_destino": T.StructType(
        [
            _f("sk_moeda_destino", _L),
            _f("id_moeda_destino", _L),
            _f("descricao_moeda_destino", _S),
            _f("pais_moeda_destino", _S),
        ]
    ),
    "dim_tipo_transacao": T.StructType(
        [
            _f("sk_tipo_transacao", _L),
            _f("id_tipo_transacao", _L),
            _f("descricao_tipo_transacao", _S),
        ]
    ),
    "dim_transporte": T.StructType(
        [
            _f("sk_transporte", _L),
            _f("id_transporte", _L),
            _f("descricao_transporte", _S),
        ]
    ),
    "fato_transacoes_internacionais": T.StructType(
        [
            _f("sk_transacao", _L),
            _f("id_transacao", _L, True),
            _f("quantidade_transacionada", _I),
            _f("valor_monetario_transacao", MONEY),
            _f("valor_convertido_transacao", MONEY, True),
            _f("taxa_cambio_transacao", RATE, True),
            _f("custo_transporte_transacao", MONEY, True),
            _f("sk_tempo", _L),
            _f("sk_pais_origem", _L),
            _f("sk_pais_destino", _L),
            _f("sk_produto", _L),
            _f("sk_categoria_produto", _L),
            _f("sk_moeda_origem", _L),
            _f("sk_moeda_destino", _L),
            _f("sk_tipo_transacao", _L),
            _f("sk_transporte", _L),
        ]
    ),
}

DIMENSIONS = [t for t in WAREHOUSE if t.startswith("dim_")]
FACT = "fato_transacoes_internacionais"

# Maximum text lengths of the warehouse model (VARCHAR(n)).
VARCHAR_LIMITS: dict[str, dict[str, int]] = {
    "dim_tempo": {"nome_do_mes": 20, "dia_da_semana": 20},
    "dim_pais_origem": {"nome_pais_origem": 100, "codigo_iso_pais_origem": 10, "bloco_economico_pais_origem": 100},
    "dim_pais_destino": {"nome_pais_destino": 100, "codigo_iso_pais_destino": 10, "bloco_economico_pais_destino": 100},
    "dim_produto": {"descricao_produto": 255},
    "dim_categoria_produto": {"descricao_categoria_produto": 100},
    "dim_moeda_origem": {"descricao_moeda_origem": 50, "pais_moeda_origem": 100},
    "dim_moeda_destino": {"descricao_moeda_destino": 50, "pais_moeda_destino": 100},
    "dim_tipo_transacao": {"descricao_tipo_transacao": 100},
    "dim_transporte": {"descricao_transporte": 100},
}

# Foreign keys of the fact: fact column -> dimension table (same column name).
FACT_FOREIGN_KEYS: dict[str, str] = {
    "sk_tempo": "dim_tempo",
    "sk_pais_origem": "dim_pais_origem",
    "sk_pais_destino": "dim_pais_destino",
    "sk_produto": "dim_produto",
    "sk_categoria_produto": "dim_categoria_produto",
    "sk_moeda_origem": "dim_moeda_origem",
    "sk_moeda_destino": "dim_moeda_destino",
    "sk_tipo_transacao": "dim_tipo_transacao",
    "sk_transporte": "dim_transporte",
}

# Business (natural) key of each dimension.  The time dimension has none: its grain
# is the timestamp, of which the date is a part.
DIMENSION_BUSINESS_KEYS: dict[str, str] = {
    "dim_pais_origem": "id_pais_origem",
    "dim_pais_destino": "id_pais_destino",
    "dim_produto": "id_produto",
    "dim_categoria_produto": "id_categoria_produto",
    "dim_moeda_origem": "id_moeda_origem",
    "dim_moeda_destino": "id_moeda_destino",
    "dim_tipo_transacao": "id_tipo_transacao",
    "dim_transporte": "id_transporte",
}
