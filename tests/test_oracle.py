"""Every registered query with oracle SQL equals DuckDB on the same tables
(sf0.001 here; the driver repeats this at sf0.01).  Queries without SQL
must run and keep a stable schema."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import digest  # noqa: E402

import __spark_entry__ as entry_mod  # noqa: E402
from basketry.plans.registry import all_queries  # noqa: E402
from basketry.sources.tables import TABLES  # noqa: E402

QUERIES = {n: q.fn for n, q in all_queries().items()}
SQL = {n: q.sql for n, q in all_queries().items() if q.sql is not None}


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["Posicion", "ID_Producto", "Nombre_Categoria", "Unidades_Vendidas"]
    assert len(rows) == 10


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_query_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() >= 0
    assert df.columns
