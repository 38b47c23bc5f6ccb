"""The operators with SQL against DuckDB on whole tables."""

from __future__ import annotations

import duckdb
import pytest

from fiscalflow.llm.oracle import ORACLE_SQL
from fiscalflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    df = QUERIES[name](spark, SF_DIR).select(*cols)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, res.fetchall()))
