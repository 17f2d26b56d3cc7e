"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from barmill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    wanted = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert sorted(names) == columns and found and found == wanted
