"""Every query with an equivalent in SQL, against DuckDB over the same files."""

import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from rastermill.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return str(v) if isinstance(v, date | datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=repr)
    rel = duck.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted([tuple(plain(r[i]) for i in at) for r in rel.fetchall()], key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    assert all(r["same"] for r in rows if "same" in r.asDict())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
