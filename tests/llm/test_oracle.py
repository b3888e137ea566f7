"""Operators that SQL can express, against DuckDB over the given tables."""

import duckdb
import pytest

from pitlane.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = [sorted(map(str, x[sorted(want.columns)].astype(object).where(x.notna(), None).values.tolist())) for x in (got, want)]
    assert rows[0] == rows[1]
