"""Every registered query against its SQL; queries without SQL must run and give a stable schema."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value



def _key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    sql_columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(sql_columns)
    order = sorted(sql_columns)
    ours = [tuple(_plain(row[c]) for c in order) for row in df.collect()]
    places = [sql_columns.index(c) for c in order]
    theirs = [tuple(_plain(row[i]) for i in places) for row in cursor.fetchall()]
    assert sorted(ours, key=_key) == sorted(theirs, key=_key)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows and len(rows[0]) == len(df.columns)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
