"""Checks, comparisons and reports over decisions, and dense row numbers over a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fuzzy
from ..functions.numeric import logit
from .decide import context, sweep


def dense_ids(df: DataFrame, by: str, tie: str, out: str = "row", parts: int | None = None) -> DataFrame:
    """df with 0-based positions in the order of by (a number) and tie (a unique key), without sorting all rows in one task.

    Rows are dealt into ranges of by at quantiles; a row's number is its place in its range plus the rows of the ranges
    before it. Of these there are as many as parts, whatever the table. Nulls come first.
    """
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    edges = df.agg(F.percentile_approx(by, shares, 10_000)).first()[0] or []
    part = sum((F.coalesce(F.col(by) > e, F.lit(False)).cast("int") for e in sorted(set(edges))), F.lit(0))
    dealt = df.withColumn("_part", part)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per range
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(by).asc_nulls_first(), tie))
    return dealt.withColumn("_place", place).join(sizes.select("_part", before.alias("_before")), "_part").withColumn(out, F.col("_before") + F.col("_place") - 1).drop("_part", "_place", "_before")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (equal, only_a, only_b): whether two relations of the same columns hold the same rows as often."""
    signed = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    per = signed.groupBy(*a.columns).agg(F.sum("_side").alias("d"))
    more = lambda sign: F.coalesce(F.sum(F.greatest(sign * F.col("d"), F.lit(0))), F.lit(0)).cast("long")
    return per.agg(more(1).alias("only_a"), more(-1).alias("only_b")).select(((F.col("only_a") == 0) & (F.col("only_b") == 0)).alias("equal"), "only_a", "only_b")


def gate(matches: DataFrame, candidates: DataFrame, queries: DataFrame, sep: str = ",") -> DataFrame:
    """(name, n_bad) of the checks that results (s1_row, ids) must pass before they are handed in; queries: (s1_row)."""
    out = []
    pairs = {}
    for name, lists in (("matching", matches), ("candidate", candidates)):
        per = lists.groupBy("s1_row").agg(F.count("*").alias("n"))
        out += [
            per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad")).select(F.lit(f"{name}: repeated rows").alias("name"), "n_bad"),
            lists.join(queries, "s1_row", "left_anti").agg(F.count("*").alias("n_bad")).select(F.lit(f"{name}: unknown queries").alias("name"), "n_bad"),
            queries.join(lists, "s1_row", "left_anti").agg(F.count("*").alias("n_bad")).select(F.lit(f"{name}: missing queries").alias("name"), "n_bad"),
        ]
        pairs[name] = lists.where("ids <> ''").select("s1_row", F.explode(F.split("ids", sep)).alias("id"))
        twice = pairs[name].groupBy("s1_row", "id").agg(F.count("*").alias("n"))
        out += [
            pairs[name].agg(F.count_if(F.col("id") == "").alias("n_bad")).select(F.lit(f"{name}: empty ids").alias("name"), "n_bad"),
            twice.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad")).select(F.lit(f"{name}: repeated ids").alias("name"), "n_bad"),
        ]
    out.append(pairs["matching"].join(pairs["candidate"], ["s1_row", "id"], "left_anti").agg(F.count("*").alias("n_bad")).select(F.lit("matches that are no candidates").alias("name"), "n_bad"))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("n_bad", F.col("n_bad").cast("long"))


def compared(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """by (null: all), f_a, f_b, gain, se, n: two systems' scores (s1_row, by, f05) over the same queries."""
    both = a.select("s1_row", by, F.col("f05").alias("a")).join(b.select("s1_row", F.col("f05").alias("b")), "s1_row").withColumn("d", F.col("b") - F.col("a"))
    return both.groupingSets([[by], []], by).agg(F.avg("a").alias("f_a"), F.avg("b").alias("f_b"), F.avg("d").alias("gain"), (F.stddev_samp("d") / F.sqrt(F.count("*"))).alias("se"), F.count("*").alias("n"), F.grouping(by).cast("int").alias("whole"))


def token_asymmetry(pairs: DataFrame, words: list[str], t: float, least: int) -> DataFrame:
    """country, tok, n, n_kept, kept_rate, true_rate, kept_true: pairs whose pool name has a word that the query's lacks.

    pairs: (country, p, label, name, pool_name), names in words separated by spaces. Groups of fewer than least pairs are left out.
    """
    own, pool = F.split("name", " "), F.split("pool_name", " ")
    lacking = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.array_contains(pool, w) & ~F.array_contains(own, w))
    each = pairs.select("country", "label", (F.col("p") > t).alias("kept"), F.explode(lacking).alias("tok"))
    out = each.groupBy("country", "tok").agg(F.count("*").alias("n"), F.count_if("kept").alias("n_kept"), F.avg(F.col("kept").cast("int")).alias("kept_rate"), F.avg("label").alias("true_rate"), F.avg(F.when(F.col("kept"), F.col("label"))).alias("kept_true"))
    return out.where(F.col("n") >= least)


def top_pair_means(pairs: DataFrame, values: list[str], t: float) -> DataFrame:
    """country, n, mean and share of full values of each query's best pair, where its p is above t."""
    rank = F.row_number().over(Window.partitionBy("s1_row").orderBy(F.desc("p"), "pool_row"))
    top = pairs.withColumn("rank", rank).where((F.col("rank") == 1) & (F.col("p") > t))
    cols = [c for v in values for c in (F.avg(v).alias(f"{v}_mean"), F.avg((F.col(v) >= 0.999).cast("int")).alias(f"{v}_full"))]
    return top.groupBy("country").agg(F.count("*").alias("n"), *cols)


def gated_sweep(pairs: DataFrame, truth: DataFrame, gates: DataFrame, grid: tuple[float, ...], injective: bool = True) -> DataFrame:
    """(g, k, f05): the threshold sweep among the queries whose gate (s1_row, gate) reaches g; the others emit nothing."""
    gated, out = pairs.join(gates, "s1_row"), None
    for g in grid:
        part = sweep(gated.where(F.col("gate") >= g).drop("gate"), truth, (0.0,), injective).select(F.lit(g).alias("g"), "k", "f05")
        out = part if out is None else out.unionByName(part)
    return out


def second_stage(pairs: DataFrame, texts: DataFrame, t: float) -> DataFrame:
    """All 18 features of the second stage: pairs (s1_row, pool_row, p1, xenc, inb, pf), texts (pool_row, name, addr).

    What the siblings of a pair look like comes from its query's best other candidate.
    """
    base = context(pairs.withColumnRenamed("pf", "p"), t)
    names = {"p": "pf", "p_rank": "pf_rank", "p_max": "pf_max", "p_2nd": "pf_2nd", "p_n_t": "pf_n_t", "p_sum": "pf_sum", "p_gap": "pf_gap", "ref_p": "ref_pf"}
    d = base.withColumnsRenamed(names).withColumn("lpf", logit(F.col("pf")))
    own = texts.select("pool_row", F.coalesce("name", F.lit("")).alias("_name"), F.coalesce("addr", F.lit("")).alias("_addr"))
    other = own.select(F.col("pool_row").alias("ref_row"), F.col("_name").alias("_ref_name"), F.col("_addr").alias("_ref_addr"))
    blank = {c: "" for c in ("_name", "_addr", "_ref_name", "_ref_addr")}
    d = d.join(own, "pool_row", "left").join(other, "ref_row", "left").na.fill(blank)
    has, addressed = F.col("ref_row").isNotNull(), (F.col("_addr") != "") & (F.col("_ref_addr") != "")
    given = lambda c, when: F.when(when, F.col(c))
    alike = fuzzy.similarities({
        "sib_n_ratio": ("ratio", given("_name", has), F.col("_ref_name")), "sib_n_tset": ("tset", given("_name", has), F.col("_ref_name")),
        "sib_a_tset": ("tset", given("_addr", has & addressed), F.col("_ref_addr")),
    })
    same = lambda c: F.count("*").over(Window.partitionBy("s1_row", c))
    d = d.withColumns({"_alike": alike, "sib_same_addr": ((F.col("_addr") == F.col("_ref_addr")) & (F.col("_addr") != "")).cast("int"), "n_same_addr": F.when(F.col("_addr") != "", same("_addr")), "n_same_name": same("_name")})
    return d.select("*", "_alike.*").drop("_alike", "ref_row", *blank)


def worth_it(cheap: DataFrame, dear: DataFrame) -> DataFrame:
    """One row (gain, se, choice) of two backends' scores (s1_row, f05): the dear one only for more than two standard errors."""
    from .decide import paired

    d = paired(cheap, dear)
    return d.select("gain", "se", F.when(F.col("gain") > 2 * F.col("se"), "dear").otherwise("cheap").alias("choice"))


def recall_grid(truth: DataFrame, views: dict[str, DataFrame], mixes: list[dict[str, int]], caps: tuple[int, ...], by: str) -> DataFrame:
    """(mix, cap, by, n_true, n_found): true pairs (s1_row, pool_row, by) found when each view gives its first k and a query at most cap.

    views: top-k candidates (s1_row, pool_row, country, score, rank) at the largest k of all mixes.
    """
    from .blocking import merged

    out = None
    for n, mix in enumerate(mixes):
        first = {v: x.where(F.col("rank") <= mix.get(v, 0)) for v, x in views.items() if mix.get(v)}
        found = truth.join(merged(first, max(caps)).select("s1_row", "pool_row", "cand_pos"), ["s1_row", "pool_row"], "left")
        each = found.select(by, F.explode(F.array(*[F.struct(F.lit(c).alias("cap"), (F.coalesce("cand_pos", F.lit(max(caps))) < c).alias("hit")) for c in caps])).alias("x"))
        part = each.groupBy(F.lit(n).alias("mix"), F.col("x.cap").alias("cap"), by).agg(F.count("*").alias("n_true"), F.count_if("x.hit").alias("n_found"))
        out = part if out is None else out.unionByName(part)
    return out
