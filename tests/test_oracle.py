"""Every query of the catalogue against its DuckDB twin, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from millrace.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(x):
    x = x.item() if hasattr(x, "item") else x
    return None if x is pd.NaT or (isinstance(x, float) and math.isnan(x)) else x


def table(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(plain(r[i]) for i in at)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, small, name):
    df = catalogue.QUERIES[name](spark, small)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalogue.ORACLE:
        assert rows
        return
    cur = duck.execute(catalogue.ORACLE[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, rows) == table(columns, cur.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(e.queries()) and set(catalogue.ORACLE) <= set(e.oracle_sql())
