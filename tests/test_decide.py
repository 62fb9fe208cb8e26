"""Decision rules on a small fixture with known answers, and the one-pass sweep against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from affinis.operators import decide, truthset


@pytest.fixture(scope="module")
def small(spark):
    pairs = spark.createDataFrame([(0, 10, 1, 0.90), (0, 11, 1, 0.80), (0, 12, 0, 0.70), (1, 13, 0, 0.20), (3, 12, 0, 0.95)], "s1_row long, pool_row long, label int, p double")
    truth = spark.createDataFrame([(0, "x", 2, 2), (1, "x", 0, 0), (2, "y", 1, 0), (3, "y", 0, 0)], "s1_row long, country string, n_gt long, n_gtc long")
    return pairs.cache(), truth.cache()


def kept(df):
    return sorted((r.s1_row, r.pool_row) for r in df.collect())


def test_selection_rules(small):
    pairs, _ = small
    assert kept(decide.select(pairs, 0.5)) == [(0, 10), (0, 11), (0, 12), (3, 12)]
    assert kept(decide.select(pairs, 0.5, injective=True)) == [(0, 10), (0, 11), (3, 12)]
    assert kept(decide.select(pairs, 0.5, 0.95)) == [(0, 10), (3, 12)]


def test_scores_and_loss_parts(small):
    pairs, truth = small
    scores = decide.per_query(decide.select(pairs, 0.5), truth)
    f = [round(r.f05, 7) for r in scores.orderBy("s1_row").collect()]
    assert f == [0.7142857, 1.0, 0.0, 0.0]
    assert decide.per_query(decide.select(pairs, 0.5, injective=True), truth).orderBy("s1_row").first().f05 == 1.0
    parts = decide.loss_parts(scores).agg(*[F.avg(c).alias(c) for c in ("singleton_emit", "blocking_miss", "model_miss", "false_pos")], F.avg(1 - F.col("f05")).alias("loss")).first()
    assert abs(sum(parts[:4]) - parts.loss) < 1e-9 and parts.blocking_miss == 0.25


def test_plateau(spark):
    swept = spark.createDataFrame([(0.0, k, f) for k, f in zip((10, 11, 12, 13, 14), (0.5, 0.8, 0.8, 0.8, 0.6))], "r double, k int, f05 double")
    best = decide.choose(swept, 0.001).first()
    assert (best.k, best.lo, best.hi) == (12, 11, 13)


@pytest.mark.parametrize("injective", [False, True])
def test_sweep_is_brute_force(spark, injective):
    rng = random.Random(3)
    rows = [(s, rng.randrange(12), rng.randrange(2), rng.randrange(101) / 100) for s in range(15) for _ in range(rng.randrange(5))]
    rows = list({(s, q): (s, q, y, p) for s, q, y, p in rows}.values())
    pairs = spark.createDataFrame(rows, "s1_row long, pool_row long, label int, p double").cache()
    truth = spark.createDataFrame([(s, "x", sum(y for a, _, y, _ in rows if a == s) + (s % 4 == 0), 0) for s in range(16)], "s1_row long, country string, n_gt long, n_gtc long").cache()
    got = {(r.r, r.k): r.f05 for r in decide.sweep(pairs, truth, injective=injective).collect()}
    assert len(got) == 2 * 97
    gt = {r.s1_row: r.n_gt for r in truth.collect()}
    for r in (0.0, 0.5):
        for k in range(2, 99, 3):
            best = {}
            for s, _, _, p in rows:
                best[s] = max(best.get(s, 0), p)
            keep = [(s, q, y, p) for s, q, y, p in rows if p >= k / 100 and p >= r * best[s]]
            if injective:
                win = {}
                for x in sorted(keep, key=lambda x: (-x[3], x[0])):
                    win.setdefault(x[1], x)
                keep = list(win.values())
            total = 0.0
            for s in range(16):
                n, tp = sum(x[0] == s for x in keep), sum(x[2] for x in keep if x[0] == s)
                total += (n == 0) if gt[s] == 0 else 1.25 * tp / (0.25 * gt[s] + n)
            assert abs(total / 16 - got[r, k]) < 1e-9, (r, k)


def test_truth_lists_and_splits(spark):
    df = spark.createDataFrame([("a", "x, y"), ("b", ""), ("c", None)], "id string, ids string")
    assert [tuple(r) for r in truthset.exploded(df, "id", "ids").collect()] == [("a", "x"), ("a", "y")]
    who = spark.range(1000).select("id", (F.col("id") % 4).alias("country"))
    parts = {k: {r.id for r in rows} for k, rows in ((k, truthset.splits(who, 200, 100, 40, 80, "country", "id").where(F.col("split") == k).collect()) for k in ("train", "val", "early", "holdout"))}
    assert [len(parts[k]) for k in ("train", "val", "early", "holdout")] == [200, 100, 40, 80]
    assert parts["early"] < parts["train"] and not parts["val"] & parts["train"] and not parts["holdout"] & (parts["train"] | parts["val"])
