"""Every registered query against the SQL that states its result."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    expected = con.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, rows) == table(names, expected.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() == 25 and out.columns[0] == "ticker"
