"""Every catalog query against its SQL in DuckDB, value by value."""

import math

import duckdb
import pytest

from barmill.plans import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES = catalog.QUERIES
ORACLES = oracle.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield con
    con.close()


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kept = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(kept, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    expected = sorted_rows([d[0] for d in result.description], result.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert len(got[1]) > 0
    assert got[1] == expected[1]
