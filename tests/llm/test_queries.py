"""Every registered query of the training-data operators against its SQL in DuckDB, or its rows where SQL can't express it."""

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.llm import queries

SF = "/root/testdata/sf0.001"


def as_text(rows, columns):
    return sorted(tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for _, v in sorted(zip(columns, r, strict=True))) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_its_sql(spark, name):
    got = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert as_text([tuple(r) for r in got.collect()], got.columns) == as_text(want.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_has_a_row_for_each_document(spark, name):
    got = entry.queries()[name](spark, SF).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
