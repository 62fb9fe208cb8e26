"""Queries over checks, comparisons, reports and model variants, each beside its DuckDB form (none where SQL can't express it)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocking, decide, model, reports
from .catalogue import _FEATURES, _SWEPT, CLAIMED, KEPT, PAIRS, SCORES, TRUTH, _labelled, _rounded, _system, query
from .relations import page_records, records, scored, spine, table, truth

#: Words that stand for the corporate words of the report.
WORDS = ["widget", "gear", "bolt", "ring", "gizmo", "red", "hot"]

NAMED = """named as (
    select pairs.*, q.country, a.p_name as name, b.p_name as pool_name, b.p_type as addr from pairs join queries q using (s1_row)
        join (select l_orderkey as s1_row, min_by(l_partkey, (l_linenumber, l_partkey)) as own from lineitem group by 1) o using (s1_row)
        join part a on a.p_partkey = own join part b on b.p_partkey = pool_row)"""


def _named(spark, d):
    """Scored pairs with the name of their query (its first part) and of their pool row."""
    own = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("s1_row")).agg(F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("own"))
    part = table(spark, d, "part")
    mine = part.select(F.col("p_partkey").alias("own"), F.col("p_name").alias("name"))
    pool = part.select(F.col("p_partkey").alias("pool_row"), F.col("p_name").alias("pool_name"), F.col("p_type").alias("addr"))
    return scored(spark, d).join(spine(spark, d), "s1_row").join(own, "s1_row").join(mine, "own").join(pool, "pool_row").drop("own")


@query("o059_dense_ids", "select c_custkey, row_number() over (order by c_acctbal, c_custkey) - 1 as row from customer")
def _(spark, d):
    return reports.dense_ids(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey").select("c_custkey", "row")


@query("o072_relation_equality", f"""with {PAIRS}, b as (select s1_row, pool_row, case when s1_row % 100 = 0 then 1 - label else label end as label from pairs), a as (select s1_row, pool_row, label from pairs),
    x as (select count(*) as n from (select * from a except all select * from b)), y as (select count(*) as n from (select * from b except all select * from a))
    select x.n = 0 and y.n = 0 as equal, x.n as only_a, y.n as only_b from x, y""")  # fmt: skip
def _(spark, d):
    a = scored(spark, d).select("s1_row", "pool_row", "label")
    return reports.difference(a, a.withColumn("label", F.when(F.col("s1_row") % 100 == 0, 1 - F.col("label")).otherwise(F.col("label"))))


def _lists(name: str, of: str) -> str:
    return f"{name} as (select q.s1_row, coalesce(string_agg(pool_row::varchar, ',' order by pool_row), '') as ids from queries q left join {of} using (s1_row) where q.s1_row % 1000 <> 999 group by 1)"


@query("o152_gate", f"""with {TRUTH}, {KEPT.format(t=0.5, r=0)}, few as (select * from pairs where p >= 0.52), {_lists('m', 'kept')}, {_lists('c', 'few')},
    mp as (select s1_row, unnest(string_split(ids, ',')) as id from m where ids <> ''), cp as (select s1_row, unnest(string_split(ids, ',')) as id from c where ids <> ''),
    missing as (select count(*) as n from queries where s1_row not in (select s1_row from m))
    select unnest([name || ': repeated rows', name || ': unknown queries', name || ': empty ids', name || ': repeated ids']) as name, 0::bigint as n_bad from (values ('matching'), ('candidate')) t (name)
    union all select name || ': missing queries', n from missing, (values ('matching'), ('candidate')) t (name)
    union all select 'matches that are no candidates', count(*) from (select * from mp except select * from cp)""")  # fmt: skip
def _(spark, d):
    pairs, queries = scored(spark, d), spine(spark, d).select("s1_row")
    some = queries.where("s1_row % 1000 <> 999")  # results that lack queries
    return reports.gate(decide.id_list(decide.select(pairs, 0.5), some), decide.id_list(pairs.where("p >= 0.52"), some), queries)


@query("o150_compare", f"""with {TRUTH}, {CLAIMED.format(t=0.3, r=0.5)}, {SCORES.format(kept='won')}, one as (select s1_row, country, f05 from scores),
    two as (select s1_row, case when n_gt = 0 then (coalesce(n_pred, 0) = 0)::double else 1.25 * coalesce(tp, 0)::double / (0.25 * n_gt::double + coalesce(n_pred, 0)) end as f05
        from truth left join (select s1_row, count(*) as n_pred, sum(label) as tp from pairs where p >= 0.5 group by 1) using (s1_row)),
    both_ as (select country, one.f05 as a, two.f05 as b from one join two using (s1_row))
    select country, round(avg(a), 6) as f_a, round(avg(b), 6) as f_b, round(avg(b - a), 6) as gain, round(stddev_samp(b - a) / sqrt(count(*)), 6) as se, count(*) as n, grouping(country)::integer as whole
    from both_ group by grouping sets ((country), ())""")  # fmt: skip
def _(spark, d):
    return _rounded(reports.compared(_system(spark, d, 0.3, 0.5, True), _system(spark, d), "country"), "f_a", "f_b", "gain", "se")


@query("o146_corp_tokens", f"""with {TRUTH}, {NAMED}, each as (select country, label, p > 0.71 as kept, unnest(list_filter({WORDS}, lambda w: list_contains(string_split(pool_name, ' '), w) and not list_contains(string_split(name, ' '), w))) as tok from named)
    select country, tok, count(*) as n, count_if(kept) as n_kept, round(avg(kept::integer), 6) as kept_rate, round(avg(label), 6) as true_rate, round(avg(case when kept then label end), 6) as kept_true
    from each group by 1, 2 having count(*) >= 20""")  # fmt: skip
def _(spark, d):
    return _rounded(reports.token_asymmetry(_named(spark, d), WORDS, 0.71, 20), "kept_rate", "true_rate", "kept_true")


@query("o147_top_pair", f"""with {TRUTH}, f as (select l_orderkey as s1_row, l_partkey as pool_row, max(l_quantity) / 50 as a_contain, max(l_discount) * 10 as a_last2 from lineitem group by 1, 2),
    top as (select p.s1_row, q.country, p.p, a_contain, a_last2 from pairs p join queries q using (s1_row) join f on f.s1_row = p.s1_row and f.pool_row = p.pool_row qualify row_number() over (partition by p.s1_row order by p.p desc, p.pool_row) = 1)
    select country, count(*) as n, round(avg(a_contain), 6) as a_contain_mean, round(avg((a_contain >= 0.999)::integer), 6) as a_contain_full, round(avg(a_last2), 6) as a_last2_mean, round(avg((a_last2 >= 0.999)::integer), 6) as a_last2_full
    from top where p > 0.9 group by 1""")  # fmt: skip
def _(spark, d):
    f = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("s1_row"), F.col("l_partkey").alias("pool_row")).agg((F.max("l_quantity") / 50).alias("a_contain"), (F.max("l_discount") * 10).alias("a_last2"))
    pairs = scored(spark, d).join(spine(spark, d), "s1_row").join(f, ["s1_row", "pool_row"])
    out = reports.top_pair_means(pairs, ["a_contain", "a_last2"], 0.9)
    return _rounded(out, *[c for c in out.columns if c.startswith("a_")])


def _gates(spark, d):
    """A stand-in for the gate's model: what the best pair promises."""
    return scored(spark, d).groupBy("s1_row").agg(F.max("p").alias("gate"))


@query("o139_gate_sweep", f"""with {TRUTH}, grid as (select unnest(range(2, 99))::integer as k), gs as (select unnest([0.0, 0.6, 0.9])::double as g),
    rel as (select g, pairs.* from pairs join (select s1_row, max(p) as gate from pairs group by 1) using (s1_row) join gs on gate >= g),
    won as (select * from rel qualify row_number() over (partition by g, pool_row order by p desc, s1_row) = 1),
    hits as (select g, k, s1_row, count(*) as n_pred, sum(label) as tp from won join grid on p >= k / 100::double group by all),
    full_ as (select g, k, n_gt, coalesce(n_pred, 0) as n_pred, coalesce(tp, 0) as tp from truth t cross join grid cross join gs left join hits using (g, k, s1_row))
    select g, k, round(avg(case when n_gt = 0 then (n_pred = 0)::double else 1.25 * tp::double / (0.25 * n_gt::double + n_pred) end), 6) as f05 from full_ group by all""")  # fmt: skip
def _(spark, d):
    pairs = scored(spark, d)
    return _rounded(reports.gated_sweep(pairs, truth(pairs, spine(spark, d)), _gates(spark, d), (0.0, 0.6, 0.9)), "f05")


@query("o134_same_counts", f"""with {TRUTH}, {NAMED} select s1_row, pool_row, count(*) over (partition by s1_row, addr) as n_same_addr, count(*) over (partition by s1_row, pool_name) as n_same_name, round(ln(least(greatest(p, 0.000001), 0.999999) / (1 - least(greatest(p, 0.000001), 0.999999))), 6) as lpf from named""")
def _(spark, d):
    return _rounded(second_stage(spark, d).select("s1_row", "pool_row", "n_same_addr", "n_same_name", "lpf"), "lpf")


def second_stage(spark, d):
    named = _named(spark, d)
    pairs = named.select("s1_row", "pool_row", F.round(F.col("p") * 0.9, 6).alias("p1"), F.when(F.col("p").between(0.002, 0.998), F.col("label") * 0.5).otherwise(0.0).alias("xenc"), F.col("p").between(0.002, 0.998).cast("int").alias("inb"), F.col("p").alias("pf"))
    texts = table(spark, d, "part").select(F.col("p_partkey").alias("pool_row"), F.col("p_name").alias("name"), F.col("p_type").alias("addr"))
    return reports.second_stage(pairs, texts, 0.71)


query("o134_second_stage")(second_stage)


@query("o116_recall_grid")
def _(spark, d):
    r = page_records(spark, d)
    key = F.md5(F.array_join("name", " "))
    same = r.where("src = 'S1' and size(name) > 0").select(F.col("id").alias("s1_row"), "country", key.alias("k")).join(r.where("src <> 'S1'").select(F.col("id").alias("pool_row"), "country", key.alias("k")), ["country", "k"]).drop("k")
    views = {v: blocking.top_k(r, v, 40) for v in ("W_all", "C_all")}
    return reports.recall_grid(same, views, [{"W_all": 40}, {"C_all": 40}, {"W_all": 20, "C_all": 20}, {"W_all": 40, "C_all": 40}], (10, 30, 50), "country")


# Models

@query("o066_importance")
def _(spark, d):
    data = _labelled(spark, d)
    top = model.importance(model.fit_trees(data, _FEATURES, rounds=5), _FEATURES)[:12]
    return spark.createDataFrame(top, "feature string, importance double")


def _loss(df, p="p"):
    """Mean log loss, and rows."""
    q = F.least(F.greatest(F.col(p), F.lit(1e-6)), F.lit(1 - 1e-6))
    return df.agg(F.avg(-F.when(F.col("label") == 1, F.ln(q)).otherwise(F.ln(1 - q))).alias("loss"), F.count("*").alias("n"))


@query("o129_ablation")
def _(spark, d):
    """Held-out loss without the features of a prefix, and on a country that the fit has not seen."""
    data = _labelled(spark, d).join(table(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("country")), "doc_id")
    fit, held = data.where("fold = 0"), data.where("fold = 1")
    out = None
    for prefix in ("", "n_", "mean", "symbols", "lines"):
        use = [f for f in _FEATURES if not prefix or not f.startswith(prefix)]
        part = _loss(model.probability(model.fit_trees(fit, use, rounds=5), held, use)).select(F.lit(f"without {prefix}" if prefix else "all").alias("variant"), "loss", "n")
        out = part if out is None else out.unionByName(part)
    for c in [r.country for r in data.select("country").distinct().orderBy("country").collect()]:  # a few countries
        trees = model.fit_trees(data.where(F.col("country") != c), _FEATURES, rounds=5)
        out = out.unionByName(_loss(model.probability(trees, data.where(F.col("country") == c), _FEATURES)).select(F.lit(f"unseen {c}").alias("variant"), "loss", "n"))
    return out


@query("o141_bagging")
def _(spark, d):
    """Mean probability of models that differ by seed."""
    data = _labelled(spark, d)
    return model.bagged(data, _FEATURES, seeds=(1, 2, 3), rounds=5).select("doc_id", "label", "p")


@query("o132_combiner_cross_fit")
def _(spark, d):
    pairs = scored(spark, d).withColumn("s", (F.col("pool_row") % 10) / 10.0).withColumn("fold", F.pmod("s1_row", F.lit(2)))

    def fit(part):
        intercept, w = model.fit_combiner(part)
        return lambda rest: rest.withColumn("q", decide.combined(F.col("p"), F.col("s"), intercept, w, 0.01, 0.99))

    return model.cross_fitted(pairs, "fold", 2, fit).select("s1_row", "pool_row", "q")


@query("o135_refit")
def _(spark, d):
    """Two folds with early stopping, then one fit on all rows with their mean number of trees."""
    data = _labelled(spark, d)
    trees = model.refitted(data, _FEATURES, "fold", 2, "early", rounds=8)
    return model.probability(trees, data, _FEATURES).select("doc_id", "label", "p", F.lit(trees.getNumTrees).alias("n_trees"))


@query("o128_backend", f"""with {TRUTH}, {KEPT.format(t=0.5, r=0)}, {SCORES.format(kept='kept')}, won as (select * from kept qualify row_number() over (partition by pool_row order by p desc, s1_row) = 1),
    b as (select s1_row, case when n_gt = 0 then (coalesce(n_pred, 0) = 0)::double else 1.25 * coalesce(tp, 0)::double / (0.25 * n_gt::double + coalesce(n_pred, 0)) end as f
        from truth left join (select s1_row, count(*) as n_pred, sum(label) as tp from won group by 1) using (s1_row)),
    d as (select avg(f - f05) as gain, stddev_samp(f - f05) / sqrt(count(*)) as se from scores join b using (s1_row))
    select round(gain, 6) as gain, round(se, 6) as se, case when gain > 2 * se then 'dear' else 'cheap' end as choice from d""")  # fmt: skip
def _(spark, d):
    return _rounded(reports.worth_it(_system(spark, d), _system(spark, d, injective=True)), "gain", "se")
