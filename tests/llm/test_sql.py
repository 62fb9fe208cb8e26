"""The queries that have a DuckDB form agree with it."""

from collections import Counter

import duckdb
import pytest

from affinis.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(registry.ORACLES[name])
    df = registry.QUERIES[name](spark, SF)
    order = sorted(rel.columns)
    assert order == sorted(df.columns)
    want = Counter(tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in df.collect()) == want
