"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from tallgrass.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


def rows(frame):
    def value(v):
        if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return None
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    columns = sorted(frame.columns)
    return columns, sorted((tuple(value(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert name in ORACLES
    a, b = rows(got), rows(duck.sql(ORACLES[name]).df())
    number = lambda r: tuple(None if v is None else f"{float(v):.9g}" if _is_number(v) else v for v in r)
    assert a[0] == b[0]
    assert sorted(map(str, map(number, a[1]))) == sorted(map(str, map(number, b[1])))


def _is_number(v):
    try:
        float(v)
    except ValueError:
        return False
    return True
