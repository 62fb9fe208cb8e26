"""Decisions over scored pairs (s1_row, pool_row, p, label) and their exact evaluation over all queries.

truth: (s1_row, country, n_gt, n_gtc), one row per query. Selection keeps pairs with p >= t and p >= r * the query's best;
the injective pass then leaves each pool row to its best kept query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import f_score

GRID = (0.02, 0.98)  # 97 thresholds, 0.01 apart


def relative(pairs: DataFrame, r: float) -> DataFrame:
    best = F.max("p").over(Window.partitionBy("s1_row"))
    return pairs.withColumn("best", best).where(F.col("p") >= r * F.col("best")).drop("best")


def winners(pairs: DataFrame) -> DataFrame:
    order = Window.partitionBy("pool_row").orderBy(F.desc("p"), "s1_row")
    return pairs.withColumn("claim", F.row_number().over(order)).where("claim = 1").drop("claim")


def select(pairs: DataFrame, t: float, r: float = 0.0, injective: bool = False) -> DataFrame:
    kept = relative(pairs, r).where(F.col("p") >= t)
    return winners(kept) if injective else kept


def per_query(kept: DataFrame, truth: DataFrame) -> DataFrame:
    """truth with n_pred, tp and f05 of each query."""
    sums = kept.groupBy("s1_row").agg(F.count("*").alias("n_pred"), F.sum("label").cast("long").alias("tp"))
    full = truth.join(sums, "s1_row", "left").na.fill(0, ["n_pred", "tp"])
    return full.withColumn("f05", f_score(F.col("tp"), F.col("n_gt"), F.col("n_pred")))


def macro(scores: DataFrame, *by: str) -> DataFrame:
    """Mean f05, its standard error and the number of queries."""
    return scores.groupBy(*by).agg(F.avg("f05").alias("f05"), (F.stddev_samp("f05") / F.sqrt(F.count("*"))).alias("se"), F.count("*").alias("n"))


def sweep(pairs: DataFrame, truth: DataFrame, rs: tuple[float, ...] = (0.0, 0.5), injective: bool = True) -> DataFrame:
    """(r, k, f05): the macro mean at each threshold k / 100, in one pass per r.

    The winner of a pool row among relative-kept pairs is the same at every threshold it survives, so winners are taken
    once; a pair counts at all k up to floor(100 p), and only a query's changes are summed. What a query scores before
    its first change is its score without predictions.
    """
    lo, hi = round(GRID[0] * 100), round(GRID[1] * 100)
    out = None
    for r in rs:
        kept = relative(pairs, r)
        kept = winners(kept) if injective else kept
        level = F.least(F.floor(F.col("p") * 100 + 1e-9), F.lit(hi)).cast("int")
        steps = kept.withColumn("k", level).where(F.col("k") >= lo).groupBy("s1_row", "k").agg(F.count("*").alias("d_pred"), F.sum("label").alias("d_tp"))
        down = Window.partitionBy("s1_row").orderBy(F.desc("k"))
        run = steps.join(truth.select("s1_row", "n_gt"), "s1_row").select("s1_row", "k", "n_gt", F.sum("d_pred").over(down).alias("n_pred"), F.sum("d_tp").over(down).alias("tp"))
        score = f_score(F.col("tp"), F.col("n_gt"), F.col("n_pred"))
        idle = (F.col("n_gt") == 0).cast("double")
        gain = run.withColumn("f", score).withColumn("gain", F.col("f") - F.coalesce(F.lag("f").over(down), idle))
        change = gain.groupBy("k").agg(F.sum("gain").alias("gain"))
        base = truth.agg(F.sum((F.col("n_gt") == 0).cast("double")).alias("base"), F.count("*").alias("n"))
        grid = truth.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("k"))
        total = F.sum(F.coalesce("gain", F.lit(0.0))).over(Window.partitionBy("one").orderBy(F.desc("k")))  # 97 rows
        each = grid.join(change, "k", "left").join(base.withColumn("one", F.lit(1)), F.lit(1) == F.col("one"))
        part = each.select(F.lit(r).alias("r"), "k", ((F.col("base") + total) / F.col("n")).alias("f05"))
        out = part if out is None else out.unionByName(part)
    return out


def choose(swept: DataFrame, tolerance: float = 0.0005) -> DataFrame:
    """One row (r, k, f05, lo, hi): the best r (smallest on a tie) and the middle of its plateau around the first maximum."""
    near = F.col("f05") >= F.max("f05").over(Window.partitionBy("r")) - tolerance
    rank = Window.partitionBy("r").orderBy("k")
    runs = swept.withColumn("near", near).withColumn("run", F.col("k") - F.sum(F.col("near").cast("int")).over(rank))
    flat = runs.where("near").groupBy("r", "run").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.max("f05").alias("top"), F.max_by(-F.col("k"), F.col("f05")).alias("x"))
    first = Window.orderBy(F.desc("top"), "r", "lo")  # a row per plateau
    best = flat.withColumn("n", F.row_number().over(first)).where("n = 1")
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    return best.withColumn("k", mid).join(swept.select("r", "k", "f05"), ["r", "k"]).select("r", "k", "f05", "lo", "hi")


def loss_parts(scores: DataFrame) -> DataFrame:
    """Per query: what of 1 - f05 is due to emissions for nothing, blocking, missed and false pairs."""
    reach, clean = f_score(F.col("n_gtc"), F.col("n_gt"), F.col("n_gtc")), f_score(F.col("tp"), F.col("n_gt"), F.col("tp"))
    some = F.col("n_gt") > 0
    part = lambda x: F.when(some, x).otherwise(0.0)
    return scores.withColumns({
        "singleton_emit": F.when(~some, 1 - F.col("f05")).otherwise(0.0), "blocking_miss": part(1 - reach),
        "model_miss": part(reach - clean), "false_pos": part(clean - F.col("f05")),
    })


def paired(a: DataFrame, b: DataFrame, *by: str) -> DataFrame:
    """Mean difference of two systems over the same queries and its standard error."""
    d = F.col("b.f05") - F.col("a.f05")
    both = a.alias("a").join(b.alias("b"), F.col("a.s1_row") == F.col("b.s1_row")).select(*[F.col(f"a.{c}") for c in by], d.alias("d"))
    return both.groupBy(*by).agg(F.avg("d").alias("gain"), (F.stddev_samp("d") / F.sqrt(F.count("*"))).alias("se"), F.count("*").alias("n"))


def id_list(kept: DataFrame, queries: DataFrame, sep: str = ",") -> DataFrame:
    """(s1_row, ids): each query's pool rows, best first, as a list in text; empty without any."""
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("p")).alias("q"), "pool_row")))
    ids = F.array_join(F.array_distinct(F.transform(ordered, lambda x: x["pool_row"].cast("string"))), sep)
    return queries.select("s1_row").join(kept.groupBy("s1_row").agg(ids.alias("ids")), "s1_row", "left").select("s1_row", F.coalesce("ids", F.lit("")).alias("ids"))


def context(pairs: DataFrame, t: float) -> DataFrame:
    """pairs with what a second stage sees of their query: rank, best, runner-up, count above t, sum, gap, the sibling's score."""
    w = Window.partitionBy("s1_row")
    order = w.orderBy(F.desc("p"), "pool_row")
    rank = F.row_number().over(order)
    out = pairs.withColumns({
        "p_rank": rank, "p_max": F.max("p").over(w), "p_n_t": F.sum((F.col("p") >= t).cast("long")).over(w), "p_sum": F.sum("p").over(w),
        "p_2nd": F.nth_value("p", 2).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "first_row": F.first("pool_row").over(order), "second_row": F.nth_value("pool_row", 2).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    top = F.col("p_rank") == 1
    return out.withColumns({"p_gap": F.col("p_max") - F.col("p"), "ref_row": F.when(top, F.col("second_row")).otherwise(F.col("first_row")), "ref_p": F.when(top, F.col("p_2nd")).otherwise(F.col("p_max"))}).drop("first_row", "second_row")


def combined(p: Column, s: Column, intercept: float, weights: tuple[float, float, float], lo: float, hi: float) -> Column:
    """p outside the band lo to hi; inside, a logistic model of logit p, s and their product."""
    from ..functions.numeric import logit, sigmoid

    z = F.lit(intercept) + weights[0] * logit(p) + weights[1] * s + weights[2] * logit(p) * s
    return F.when(p.between(lo, hi), sigmoid(z)).otherwise(p)
