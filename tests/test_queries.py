"""Every registered query against its SQL, on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 6)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    found = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)
    columns, sql_rows = (lambda c: ([d[0] for d in c.description], c.fetchall()))(duck.cursor().execute(entry.oracle_sql()[name]))
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert sorted(df.columns) == sorted(columns)
    assert found == sorted((tuple(plain(r[i]) for i in order) for r in sql_rows), key=str)


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
