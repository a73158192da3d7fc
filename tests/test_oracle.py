"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hestia.sources.tables import TABLES

def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["type_bien", "surface_bin", "moyenne", "mediane", "nb_obs"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, sf, duck, name):
    sdf = queries()[name](spark, sf)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, srows) == _rows(dcols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only_queries_run(spark, sf, name):
    assert queries()[name](spark, sf).count() >= 0
