"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from collabstats.llm import queries as Q
from tests.llm.conftest import SMALL


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    told = con.sql(Q.oracle_sql()[name])
    columns = sorted(told.columns)
    found = Q.queries()[name](spark, SMALL)
    assert sorted(found.columns) == columns
    want = sorted(tuple(str(r[told.columns.index(c)]) for c in columns) for r in told.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in found.collect()) == want


def test_pii_sql_on_made_texts(spark):
    from pyspark.sql import functions as F

    from collabstats.llm import pii

    texts = ["iban GB82 WEST 1234 5698 7654 32.", "GB83 WEST 1234 5698 7654 32", "my ssn 123-45-6789", "part 123-45-6789", "ssn 666-45-6789 a@b.co 4111-1111-1111-1111",
             "DE89370400440532013000x DE89370400440532013000 +1 (555) 010-2345 1.2.3.4 300.1.1.1", None, "", "é 10.0.0.1 \U0001F600 x@y.zz"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    told = con.sql(Q.oracle_sql()["op1_pii"])
    want = {r[told.columns.index("doc_id")]: r[told.columns.index("spans")] for r in told.fetchall()}
    found = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.doc_id: r.spans for r in found.select("doc_id", pii.digest(F.col("pii")).alias("spans")).collect()} == want
