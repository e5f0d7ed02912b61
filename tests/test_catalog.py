"""Every query of the catalogue against its SQL on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from auditloom import catalog

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "None" if value != value else repr(round(value, 6))
    if isinstance(value, int) and not isinstance(value, bool):
        return repr(float(value))
    if isinstance(value, list | tuple):
        return repr([plain(v) for v in value])
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.SQL:
        assert got
        return
    answer = duck.sql(catalog.SQL[name])
    assert sorted(answer.columns) == columns
    order = [answer.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in answer.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
