"""Every registered query of the library against its SQL in another engine."""

import math

import duckdb
import pytest

from urbanframe.plans import catalogue
from urbanframe.plans.fixtures import TABLES

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio"):
        return f"{round(float(value), 6) + 0.0:.6f}"
    return str(value)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def test_all_have_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    columns = sorted(names)
    assert sorted(df.columns) == columns
    at = [names.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == want
