"""Every query with SQL gives the same rows in DuckDB; every query runs."""

import datetime
import decimal
import glob
import os

import pytest

import __spark_entry__ as entry
from maskwright import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    assert got[1] or name in (), "no rows"
    if name in catalog.ORACLES:
        rel = duck.sql(catalog.ORACLES[name])
        want = rows_of(rel.columns, rel.fetchall())
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        assert got[1] == want[1]
        kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        for c, t in df.dtypes:
            assert {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}[t] == kinds[c], (c, t, kinds[c])


def test_flagship(spark):
    assert entry.entry(spark).columns == ["lang", "pans", "docs"]
