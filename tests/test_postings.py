"""Exact candidates without pairs in any exchange: the same rows from blocks of any size."""

import pytest
from pyspark.sql import functions as F

from affinis.operators import blocking, postings
from affinis.plans import catalogue


def _rows(df):
    return sorted((r.s1_row, r.pool_row, r.country, r.score, r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def words(spark):
    """1200 records in three countries (one null) of 40 words, with copies, ties, empty records and words that all have."""
    word = lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id") % 500, F.lit(i)), F.lit(60 if i % 2 else 900)).cast("string"))
    toks = F.array_distinct(F.when(F.col("id") % 97 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("all"), *[word(i) for i in range(40)])))
    return spark.range(1200).select("id", F.when(F.col("id") % 50 != 7, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("country"), F.when(F.col("id") % 4 == 0, "S1").otherwise("S2").alias("src"), toks.alias("toks"))


@pytest.mark.parametrize(("cap", "block"), [(0.05, 700), (0.3, 1 << 22), (1.0, 4000)])
def test_blocks_find_what_the_plain_join_finds(spark, words, cap, block):
    toks = words.select("id", "country", "src", F.explode("toks").alias("tok"))
    pool, asked = blocking.weights(toks, cap)
    want = _rows(blocking.search(asked, pool, 7))
    assert want and _rows(postings.top_k(words, 7, cap, block)) == want


def test_large_weights_are_summed_as_longs():
    import numpy as np

    big = np.array([2**53, 1, 1], np.int64)
    assert postings._sum(big, np.zeros(3, np.int64), 1, True)[0] == 2**53 + 2


@pytest.mark.parametrize("name", ["o031_idf_topk", "o115_all_view_topk", "o064_capped_union", "o119_reverse_competition"])
def test_pairs_meet_in_no_exchange(spark, name):
    """A join of postings, one row for each word that two records share, filled the disk on 1 GB."""
    df = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "tok" not in plan


def test_recall_by_class_lists_no_pairs(spark):
    """60 copies on either side are 3600 true pairs, which were rows of a join."""
    rows = [(i, "c", "S1" if i % 2 else "S2", "same") for i in range(120)] + [(200, "c", "S1", "x"), (201, "c", "S3", "y"), (202, None, "S1", "x"), (203, "d", "S1", "z")]
    keyed = spark.createDataFrame(rows, "id long, country string, src string, k string")
    cands = spark.createDataFrame([(1, 2), (3, 4), (200, 201), (1, 201)], "s1_row long, pool_row long")
    side = lambda where, row: keyed.where(where).select(F.col("id").alias(row), "country", "k")
    true = side("src = 'S1'", "s1_row").join(side("src <> 'S1'", "pool_row"), ["country", "k"])
    got = blocking.class_recall(keyed, cands)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, blocking.recall(true, cands, "country").collect())) == [("c", 3600, 2, 2 / 3600)]
    assert got.columns == ["country", "n_true", "n_found", "recall"]


def test_rounds_bound_the_copies_of_blocks(spark, words, monkeypatch):
    """All pairs of blocks met in one exchange, whose copies grew with the square of the input."""
    import pyarrow as pa

    def meeting(k):
        def one(a, b):
            both = a.num_rows and b.num_rows
            return pa.table([[a["g"][0].as_py() * 10**6 + b["b"][0].as_py()], [0], ["c"], [1.0]] if both else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string(), pa.float64())], names=["s1_row", "pool_row", "country", "score"])

        return one

    rounds, sizes, stored = [], [], postings.stored

    def spied(df, *codec):
        out = stored(df, *codec)
        if "rank" in df.columns:
            rounds.append(out.count())
        if "groups" in df.columns:
            sizes.extend(out.collect())
        return out

    monkeypatch.setattr(postings, "stored", spied)
    monkeypatch.setattr(postings, "_best", meeting)
    postings.top_k(words, 10**6, 1.0, 150)
    blocks, pairs = sum(r.blocks + r.groups for r in sizes), sum(r.blocks * r.groups for r in sizes)
    assert pairs > 4 * blocks and sum(rounds) > 0.9 * pairs
    assert max(rounds) <= 2 * blocks


def test_numbers_of_any_size_pass_as_bytes():
    import numpy as np
    import pyarrow as pa

    parts = [postings._bytes(np.array(x), np.array([0, 2])) for x in ([1, 2, 3], [70000, 1, 2**40], [0, 300, 7])]
    both = pa.concat_arrays(parts)
    assert postings._numbers(both, np.array([2, 1] * 3)).tolist() == [1, 2, 3, 70000, 1, 2**40, 0, 300, 7]
    assert postings._numbers(both.slice(1, 3), np.array([1, 2, 1])).tolist() == [3, 70000, 1, 2**40]
    base, above = postings._based(np.array([5, postings.NO_ID, 2**62]))
    assert (np.full(3, base) + above.astype(np.int64)).tolist() == [5, postings.NO_ID, 2**62]


def test_blocks_enter_no_exchange(spark, words, monkeypatch):
    """Copies of blocks for every group that they meet were shuffled, so what was shuffled grew with the square of the input."""
    import re

    keys, stored = [], postings.stored

    def spied(df, *how):
        if "rank" in df.columns:
            plan = df._jdf.queryExecution().executedPlan().toString()
            keys.extend(re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\((.*?), \d+\)", plan))
        return stored(df, *how)

    monkeypatch.setattr(postings, "stored", spied)
    assert postings.top_k(words, 3, 1.0, 4000).count()
    assert keys and set(keys) <= {"s1_row", "g_country", "b_country"}


def test_a_task_sends_the_best_rows_of_all_its_blocks(monkeypatch):
    import pyarrow as pa

    def one(a, b):
        x = b["b"][0].as_py()
        return pa.table([[1, 1, 2], [10 * x, 10 * x + 1, 10 * x], ["c"] * 3, [x % 3 / 2, 0.25, 0.5]], ["s1_row", "pool_row", "country", "score"])

    monkeypatch.setattr(postings, "_best", lambda k: one)
    pairs = [pa.record_batch([["c"], [0], [b]], ["g_country", "g", "b"]) for b in range(5)]
    want = [(1, 20, 1.0), (1, 10, 0.5), (2, 0, 0.5), (2, 10, 0.5)]
    for held, times in ((1 << 22, 1), (1, 5)):
        monkeypatch.setattr(postings, "HELD", held)
        found = [(r["s1_row"], r["pool_row"], r["score"]) for b in postings._met(2)(iter(pairs)) for r in b.to_pylist()]
        assert len(found) == (4 if times == 1 else 15) and set(want) <= set(found)
        if times == 1:
            assert found == want


def test_names_and_views_of_odd_texts(spark, tmp_path):
    """A name looked through the whole text, and a view made all its words distinct after looking at each of them."""
    import re

    from affinis.plans import relations

    texts = [None, "", " .,", "One", "  one TWO.", "a b c d e f g h", "a b c d e f g h.", "- a\nb\tc,d;e f g h i I i 12 12 a1 ½ ٤ #7", "你好 \U00010400 İx " * 9, "x" * 70000 + " y " * 20000]
    spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    r = relations.records(spark, str(tmp_path))
    low = {x.doc_id: x.t for x in spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("doc_id", "regexp_extract_all(lower(text), '[\\\\p{L}\\\\p{N}]+', 0) t").collect()}
    for x in r.collect():
        assert (x["name"], x.addr) == ((None, None) if low[x.id] is None else (low[x.id][:8], low[x.id][8:]))
    lettered = lambda t: any(c.isalpha() for c in t)
    tagged = lambda a: {f"a:{t}" if lettered(t) else f"a:#{t}" for t in a if lettered(t) or re.fullmatch("[0-9]+", t)}
    for x in blocking.listed(r, "W_all").collect():
        words = low[x.id]
        assert (x.toks and sorted(x.toks)) == (words and sorted({f"n:{t}" for t in words[:8]} | tagged(words[8:])))
    plan = blocking.listed(r, "W_name")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == plan.count("regexp_extract_all(regexp_extract(") == 1
    assert blocking.listed(r, "W_all")._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 2
