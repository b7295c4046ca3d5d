"""Every registered query with SQL, against DuckDB on the small tables."""

import math

import duckdb
import pytest

from weir.plans import registry

DIR = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def value(x):
    return None if x is None or (isinstance(x, float) and math.isnan(x)) else str(x)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, db, name):
    df = registry.queries()[name](spark, DIR)
    names = sorted(df.columns)
    got = sorted(([value(r[c]) for c in names] for r in df.collect()), key=str)
    found = db.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert got == sorted(([value(r[k]) for k in at] for r in found.fetchall()), key=str)


def test_others_run(spark):
    for name in sorted(set(registry.queries()) - set(registry.oracle_sql())):
        assert registry.queries()[name](spark, DIR).columns
