"""Every registered query against its SQL, on the smallest given tables."""

import datetime
import decimal
import os

import pytest

from variantloom.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUN, SQL = registry.runnable(), registry.oracles()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    from variantloom.plans.bridge import TABLES

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return str(value) if isinstance(value, (datetime.date, datetime.datetime)) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, oracle, name):
    df = RUN[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = oracle.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)


def test_every_query_has_sql():
    assert set(RUN) == set(SQL)
