"""Every registered query on the smallest driver tables, next to its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of, same_type

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not there")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in entry.queries()])
def test_query(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = db.execute(sql)
    columns, types = [c[0] for c in found.description], {c[0]: str(c[1]) for c in found.description}
    assert sorted(columns) == sorted(df.columns)
    assert all(same_type(f.dataType.simpleString(), types[f.name]) for f in df.schema.fields)
    assert rows_of(df.columns, got) == rows_of(columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
