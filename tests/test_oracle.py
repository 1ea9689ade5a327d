"""Every registered query equals its DuckDB oracle (sf0.001), as the driver checks at sf0.01."""

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from comptoir import api
from helpers import duck, duck_rows, spark_rows

# The engine's own queries; those of the optional training-data part have tests of their own.
QUERIES = api.QUERIES
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    con = duck(SF_SMALL)
    cur = con.execute(ORACLE[name])
    assert sorted(d[0] for d in cur.description) == cols
    assert spark_rows(df, cols) == duck_rows(con, ORACLE[name], cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "MONTANT_TTC" in df.columns
