"""Numbers that differ beyond ten decimals are different rows."""

from __future__ import annotations

import pytest

from tradestar.operators.clean import clean_transacoes
from tradestar.schemas import BRONZE_COLUMNS


@pytest.mark.parametrize(
    "values,rows",
    [
        (["1.0", "1.00000000001"], 2),
        (["1.00000000001", "1.00000000002"], 2),
        (["1", "1.0", "1.000000000000000", "1e0", "10e-1", "0.1E+1"], 1),
        (["1.0000000001", "10000000001e-10", "1.00000000010"], 1),
        (["1e-11", "2e-11", "1e-12"], 3),
        (["1.00000000001e1", "10.0000000001", "10"], 2),
        (["1.5e5", "150000", "150000.0"], 1),
        (["1E100", "2E100"], 2),
    ],
)
@pytest.mark.parametrize("column", ["valor_monetario", "quantidade"])
def test_value_is_exact(spark, column, values, rows):
    names = BRONZE_COLUMNS["transacoes"]
    df = spark.createDataFrame([tuple(v if c == column else "1" for c in names) for v in values], ", ".join(f"{c} string" for c in names))
    assert clean_transacoes(df).count() == rows
