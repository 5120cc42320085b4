"""Every registered query against its DuckDB oracle (sf0.001 here; tools/check_oracle.py runs sf0.01)."""

from __future__ import annotations

import pytest
from compare import compare, duckdb_with_views
from samples import SMALL_SF

import __spark_entry__ as entry
from pitchflow.plans import catalog

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_with_views(SMALL_SF)


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMALL_SF)
    res = compare(df, con, SQL[name])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == [
        "temporada", "equipo", "partidos_jugados", "victorias", "empates", "derrotas",
        "goles_favor", "goles_contra", "diferencia_goles", "puntos", "posicion",
    ]


@pytest.mark.parametrize("name", ["standings", "team_performance", "silver_matches", "possession_and_accuracy"])
def test_column_order_and_types(spark, con, name):
    """Columns in the oracle's order, and the same kind of value in each."""
    df = entry.queries()[name](spark, SMALL_SF)
    told = con.sql(SQL[name])
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    assert df.columns == list(told.columns)
    assert [kinds[t] for _, t in df.dtypes] == [str(t) for t in told.types]
