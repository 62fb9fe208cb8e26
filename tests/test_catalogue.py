"""Every catalogue query runs on the smallest tables; those with SQL agree with DuckDB."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from affinis.operators import blocking
from affinis.plans import catalogue
from affinis.plans.relations import records

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 5) if math.isfinite(v) else str(v)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in catalogue._TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_agrees_with_sql(spark, duck, name):
    rel = duck.sql(catalogue.ORACLES[name])
    df = catalogue.QUERIES[name](spark, SF)
    order = sorted(rel.columns)
    assert order == sorted(df.columns)
    want = Counter(tuple(plain(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall())
    assert Counter(tuple(plain(r[c]) for c in order) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES) ))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_top_k_is_brute_force_cosine(spark):
    r = records(spark, SF)
    pool, asked = blocking.weights(blocking.tokens(r, "W_name"), 0.5)
    p, q = {}, {}
    for rows, out in ((pool.collect(), p), (asked.collect(), q)):
        for x in rows:
            out.setdefault((x.country, x.id), ({}, x.norm2))[0][x.tok] = x.q
    got = {(x.s1_row, x.pool_row): x.score for x in blocking.top_k(r, "W_name", 3, 0.5).collect()}
    for (c, i), (v, n) in list(q.items())[:20]:
        scores = sorted(((-sum(w * u[t] for t, w in v.items() if t in u) / (math.sqrt(n) * math.sqrt(m)), j) for (d, j), (u, m) in p.items() if d == c and n and m and any(t in u for t in v)))[:3]
        assert [round(-s, 9) for s, _ in scores] == [round(got[i, j], 9) for _, j in scores]
