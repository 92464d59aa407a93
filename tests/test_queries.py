"""Every query with SQL agrees with it on the small tables; the others are checked in the modules beside this one."""

import duckdb
import pandas as pd
import pytest

from corpusmill.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def shown(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(shown, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
