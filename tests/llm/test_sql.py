"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from weir.llm.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, db, name):
    df = QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    got = sorted(([r[c] for c in names] for r in df.collect()), key=str)
    found = db.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert got == sorted(([r[k] for k in at] for r in found.fetchall()), key=str)
