"""Features of candidate pairs: blocking scores, exact and fuzzy names, token sets with IDF, numbers, group context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fuzzy, text
from ..functions.numeric import safe_div

SCRIPT_CODES = {"ascii": 0, "latin_accented": 1, "indic": 2, "other": 3}


def record_features(records: DataFrame, tokens: str, prefix: str) -> DataFrame:
    """records with the number of its tokens, the sum of their IDF and the IDF of each; tokens outside the pool weigh ln N."""
    pool = records.where("src <> 'S1'")
    size = pool.groupBy("country").agg(F.count("*").alias("n_pool"))
    df = pool.select("country", F.explode(F.array_distinct(tokens)).alias("tok")).groupBy("country", "tok").agg(F.count("*").alias("df"))
    each = records.select("id", "country", F.explode(F.array_distinct(tokens)).alias("tok")).join(df, ["country", "tok"], "left").join(size, "country", "left")
    each = each.withColumn("w", F.coalesce(F.ln("n_pool") - F.ln(F.coalesce("df", F.lit(1))), F.lit(0.0)))
    own = F.map_from_entries(F.collect_list(F.struct("tok", "w")))  # as many entries as the record has tokens
    sums = each.groupBy("id").agg(F.count("*").alias(f"{prefix}_n"), F.sum("w").alias(f"{prefix}_idf"), own.alias(f"{prefix}_w"))
    return records.join(sums, "id", "left").na.fill(0, [f"{prefix}_n", f"{prefix}_idf"])


def name_frequency(records: DataFrame, name: str) -> DataFrame:
    """records with ln(1 + the pool rows of the same name)."""
    freq = records.where("src <> 'S1'").groupBy(name).agg(F.count("*").alias("n"))
    return records.join(freq, name, "left").withColumn("name_freq", F.log1p(F.coalesce("n", F.lit(0)))).drop("n")


def set_features(a: Column, b: Column, prefix: str) -> dict[str, Column]:
    """Containment and Jaccard of two token arrays, null where undefined."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    both = F.size(F.array_intersect(x, y))
    return {f"{prefix}_contain": safe_div(both, F.least(F.size(x), F.size(y))), f"{prefix}_jacc": safe_div(both, F.size(x) + F.size(y) - both)}


def number_features(a: Column, b: Column) -> dict[str, Column]:
    """Shared numbers, conflict (both have some, none shared), longest shared, same first."""
    both = F.array_intersect(a, b)
    some = (F.size(a) > 0) & (F.size(b) > 0)
    return {
        "num_shared": F.size(both), "num_conflict": (some & (F.size(both) == 0)).cast("int"),
        "num_longest": F.coalesce(F.array_max(F.transform(both, F.length)), F.lit(0)), "num_first": F.coalesce(F.get(a, 0) == F.get(b, 0), F.lit(False)).cast("int"),
    }


def exact_features(a: Column, b: Column) -> dict[str, Column]:
    first = lambda c: F.split_part(c, F.lit(" "), F.lit(1))
    return {"n_exact": F.coalesce(a == b, F.lit(False)).cast("int"), "n_first_tok": F.coalesce(first(a) == first(b), F.lit(False)).cast("int"), "n_len_diff": F.abs(F.length(a) - F.length(b))}


def script_code(script: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SCRIPT_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, script), F.lit(4))


def fuzzy_features(a: Column, b: Column, prefix: str) -> dict[str, tuple[str, Column, Column]]:
    return {f"{prefix}_{scorer}": (scorer, a, b) for scorer in fuzzy.SCORERS}


def idf_shared(a: Column, b: Column, weight: Column) -> Column:
    """Sum of the weights (a map by token) of the tokens that two arrays share."""
    return F.aggregate(F.array_intersect(a, b), F.lit(0.0), lambda sum_, t: sum_ + F.coalesce(F.try_element_at(weight, t), F.lit(0.0)))


def group_context(pairs: DataFrame, col: str, prefix: str) -> DataFrame:
    """pairs with the rank of col in its query (ties share) and the gap to the best, null counted as 0."""
    value, w = F.coalesce(col, F.lit(0.0)), Window.partitionBy("s1_row")
    return pairs.withColumns({f"{prefix}_grp_rank": F.rank().over(w.orderBy(value.desc())), f"{prefix}_grp_gap": F.max(value).over(w) - value})


def pair_features(cands: DataFrame, records: DataFrame, views: tuple[str, ...]) -> DataFrame:
    """s1_row, pool_row, country and the 53 features (with two views) of cands (s1_row, pool_row, cand_pos, score_v, rank_v).

    records: (id, country, src, name, addr arrays). The candidates are read once: what depends on tokens comes with the
    records, and all string similarities come from one Arrow pass.
    """
    from .blocking import reverse_competition

    r = record_features(record_features(records, "name", "n"), "addr", "a").withColumn("name_s", F.array_join("name", " "))
    r = name_frequency(r, "name_s").withColumns({
        "sk": text.skeleton(F.upper("name_s")), "script": script_code(text.script_class(F.col("name_s"))).cast("double"),
        "nums": F.filter("addr", lambda t: t.rlike("^[0-9]+$")), "addr_s": F.array_join("addr", " "),
    })
    side = lambda s: r.select(*[F.col(c).alias(f"{c}_{s}") for c in ("id", "src", "name", "addr", "name_s", "addr_s", "sk", "script", "nums", "n_idf", "n_w", "a_idf", "a_w", "name_freq")])
    d = cands
    for v in views:
        d = reverse_competition(d, v)
    w = Window.partitionBy("s1_row")
    gaps = {f"gap_{v}": F.max(f"score_{v}").over(w) - F.col(f"score_{v}") for v in views}
    seen = sum((F.col(f"rank_{v}").isNotNull().cast("int") for v in views), F.lit(0))
    d = d.withColumns({**gaps, "n_views": seen, "n_cands": F.count("*").over(w)})
    d = d.join(side("x"), F.col("s1_row") == F.col("id_x")).join(side("y"), F.col("pool_row") == F.col("id_y"))
    c = F.col
    spaceless = lambda s: F.replace(c(f"name_s_{s}"), F.lit(" "), F.lit(""))
    address = (F.size("addr_x") > 0) & (F.size("addr_y") > 0)
    tail = lambda s: F.slice(c(f"addr_{s}"), F.greatest(F.size(c(f"addr_{s}")) - 1, F.lit(1)), F.lit(2))
    given = lambda s: F.when(address, c(f"addr_s_{s}"))
    alike = fuzzy_features(c("name_s_x"), c("name_s_y"), "n") | fuzzy_features(c("sk_x"), c("sk_y"), "sk") | {
        "nsp_ratio": ("ratio", spaceless("x"), spaceless("y")), "nsp_partial": ("partial", spaceless("x"), spaceless("y")),
        "a_tset": ("tset", given("x"), given("y")), "a_partial": ("partial", given("x"), given("y")),
    }
    shared = {f"{p}_idf_shared": idf_shared(c(f"{t}_x"), c(f"{t}_y"), c(f"{p}_w_x")) for p, t in (("a", "addr"), ("n", "name"))}
    d = d.withColumns({
        **exact_features(c("name_s_x"), c("name_s_y")), "sk_exact": (c("sk_x") == c("sk_y")).cast("int"), **set_features(c("addr_x"), c("addr_y"), "a"),
        **number_features(c("nums_x"), c("nums_y")), "a_last2": F.size(F.array_intersect(tail("x"), tail("y"))), **shared, "alike": fuzzy.similarities(alike),
        "a_missing_s1": (F.size("addr_x") == 0).cast("int"), "a_missing_pool": (F.size("addr_y") == 0).cast("int"), "is_s3": (c("src_y") == "S3").cast("int"),
        "script_s1": c("script_x"), "script_pool": c("script_y"), "cross_script": (c("script_x") != c("script_y")).cast("int"),
        "name_freq_s1": c("name_freq_x"), "name_freq_pool": c("name_freq_y"),
    }).select("*", "alike.*")
    d = d.withColumns({f"{p}_idf_cont": safe_div(c(f"{p}_idf_shared"), F.least(f"{p}_idf_x", f"{p}_idf_y")) for p in ("a", "n")})
    d = group_context(group_context(d, "n_tset", "n"), "a_idf_cont", "a")
    return d.drop("alike", "n_idf_shared", *[x for x in d.columns if x.endswith(("_x", "_y"))])
