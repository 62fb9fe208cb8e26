"""Candidate search: IDF-weighted token views, top-k by cosine over blocks of postings, views merged under a cap.

Scores are exact in any engine: weights are round(10000 * idf) as integers, so dot products are integer sums. Words in
too large a share of a country's pool are left out of the products (not of the norms), as the queries' SQL does. search()
is the same as a plain join, for few queries at a time (the stream's).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import postings


def listed(records: DataFrame, view: str) -> DataFrame:
    """(id, country, src, toks): the distinct words or character grams of one view of the records."""
    grams = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 2, F.lit(1))), lambda i: F.substr(s, i, F.lit(3)))
    kind = lambda p: lambda t: F.when(t.rlike(r"\p{L}"), F.concat(F.lit(p), t)).when(t.rlike("^[0-9]+$"), F.concat(F.lit(f"{p}#"), t))
    addr = lambda p: F.filter(F.transform(F.array_distinct("addr"), kind(p)), lambda t: t.isNotNull())
    unique = lambda a: F.filter(F.array_distinct(a), lambda t: t != "")
    named = lambda p, a: unique(F.transform(a, lambda t: F.concat(F.lit(p), t)))
    tight = F.array_join("name", "")
    letters = F.when(F.length(tight) > 0, grams(tight)).otherwise(F.array().cast("array<string>"))
    views: dict[str, Column] = {  # parts of a view share no word, so each is made distinct on its own
        "W_name": unique("name"), "W_addr": addr(""), "W_all": F.concat(named("n:", F.col("name")), addr("a:")),
        "C_name": unique(letters), "C_all": F.concat(named("c:", letters), addr("a:")),
    }
    return records.select("id", "country", "src", views[view].alias("toks"))


def tokens(records: DataFrame, view: str) -> DataFrame:
    """(id, country, src, tok): one row for each token of a record."""
    return listed(records, view).select("id", "country", "src", F.explode("toks").alias("tok"))


def vocabulary(pool: DataFrame) -> DataFrame:
    """(country, tok, df, n, q) of the pool's tokens: documents with it, documents, weight."""
    size = pool.select("country", "id").distinct().groupBy("country").agg(F.count("*").alias("n"))
    vocab = pool.groupBy("country", "tok").agg(F.count("*").alias("df")).join(size, "country")
    return vocab.select("country", "tok", "df", "n", F.round((F.ln(F.col("n").cast("double")) - F.ln(F.col("df").cast("double"))) * 10000).cast("long").alias("q"))


def weighted(toks: DataFrame, vocab: DataFrame, cap: float) -> DataFrame:
    """(id, country, tok, q, norm2); the norm counts all words of the vocabulary, those in more than cap of the pool are dropped only then."""
    norm = F.sum(F.col("q") * F.col("q")).over(Window.partitionBy("id")).alias("norm2")
    keep = F.col("df") <= cap * F.col("n")
    return toks.join(vocab, ["country", "tok"]).select("id", "country", "tok", "q", keep.alias("use"), norm).where("use").drop("use")


def weights(toks: DataFrame, cap: float) -> tuple[DataFrame, DataFrame]:
    """(postings of the pool, tokens of the queries), each (id, country, tok, q, norm2)."""
    pool, asked = toks.where("src <> 'S1'"), toks.where("src = 'S1'")
    vocab = vocabulary(pool)
    return weighted(pool, vocab, cap), weighted(asked, vocab, cap)


def search(asked: DataFrame, pool: DataFrame, k: int) -> DataFrame:
    """(s1_row, pool_row, country, score, rank): the k postings most similar to each query, ties to the smaller id."""
    a, b = asked.alias("a"), pool.alias("b")
    pairs = a.join(b, ["country", "tok"]).groupBy(F.col("a.id").alias("s1_row"), F.col("b.id").alias("pool_row"), "country").agg(F.sum(F.col("a.q") * F.col("b.q")).alias("dot"), F.first("a.norm2").alias("x"), F.first("b.norm2").alias("y"))
    score = F.col("dot") / (F.sqrt(F.nullif("x", F.lit(0)).cast("double")) * F.sqrt(F.nullif("y", F.lit(0)).cast("double")))
    order = Window.partitionBy("s1_row").orderBy(F.desc("score"), "pool_row")
    return pairs.withColumn("score", score).where("score is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("s1_row", "pool_row", "country", "score", "rank")


def top_k(records: DataFrame, view: str, k: int, cap: float = 0.05) -> DataFrame:
    """(s1_row, pool_row, country, score, rank): each query's k most similar pool records of its country, ties to the smaller id."""
    return postings.top_k(listed(records, view), k, cap)


def merged(views: dict[str, DataFrame], cap: int) -> DataFrame:
    """(s1_row, pool_row, country, cand_pos, score_v, rank_v ...): the union of views, best ranks first, at most cap a query.

    One pass over the stacked views instead of full joins. Order: best rank, then more views, then best score, then id.
    """
    parts = [x.select("s1_row", "pool_row", "country", F.lit(v).alias("view"), "score", "rank") for v, x in views.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    pick = lambda v, c: F.max(F.when(F.col("view") == v, F.col(c)))
    cols = [pick(v, c).alias(f"{c}_{v}") for v in views for c in ("score", "rank")]
    wide = rows.groupBy("s1_row", "pool_row", "country").agg(*cols, F.min("rank").alias("r"), F.count("*").alias("n"), F.max("score").alias("s"))
    order = Window.partitionBy("s1_row").orderBy("r", F.desc("n"), F.desc("s"), "pool_row")
    return wide.withColumn("cand_pos", F.row_number().over(order) - 1).where(F.col("cand_pos") < cap).drop("r", "n", "s")


def reverse_competition(cands: DataFrame, view: str) -> DataFrame:
    """cands with this query's rank and gap among all that want the same pool row (no score counts as 0)."""
    w = Window.partitionBy("pool_row")
    score = F.coalesce(f"score_{view}", F.lit(0.0))
    return cands.withColumns({f"rc_rank_{view}": F.rank().over(w.orderBy(score.desc())), f"rc_gap_{view}": F.max(score).over(w) - score})


def dense_top_k(queries: DataFrame, pool: DataFrame, k: int, block: int = 8192, group: int = 8192) -> DataFrame:
    """(q_id, id, score, rank) by cosine of (id, v) rows, in numpy products of a block of the pool and a group of the queries.

    Both have a bounded size, whatever the tables; rows meet by block and group, never pair by pair.
    """
    import numpy as np
    import pandas as pd

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"q_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-300)
        c = c.sort_values("pool_id")
        ids, side = c["pool_id"].to_numpy(), unit(np.stack(c["pool_v"].to_numpy()).astype(float)).T
        out = []
        for at in range(0, len(q), 512):
            some = q.iloc[at : at + 512]
            s = unit(np.stack(some["v"].to_numpy()).astype(float)) @ side
            s[some["id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            best = np.argsort(-s, axis=1, kind="stable")[:, :k]
            score = np.take_along_axis(s, best, 1).ravel()
            found = pd.DataFrame({"q_id": np.repeat(some["id"].to_numpy(), best.shape[1]), "id": ids[best].ravel(), "score": score})
            out.append(found[np.isfinite(score)])
        return pd.concat(out)

    blocks, groups = (max(1, -(-df.count() // size)) for df, size in ((pool, block), (queries, group)))
    place = lambda salt, count: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(count).cast("long")).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = queries.select("id", "v", place("g", groups).alias("g"), each(blocks).alias("b"))
    held = pool.select(F.col("id").alias("pool_id"), F.col("v").alias("pool_v"), place("b", blocks).alias("b"), each(groups).alias("g"))
    near = asked.groupBy("b", "g").cogroup(held.groupBy("b", "g")).applyInPandas(search, "q_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("q_id").orderBy(F.desc(F.round("score", 9)), "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def recall(truth: DataFrame, cands: DataFrame, *by: str) -> DataFrame:
    """Share of true pairs (s1_row, pool_row, ...) that are candidates."""
    hit = truth.join(cands.select("s1_row", "pool_row", F.lit(1).alias("hit")), ["s1_row", "pool_row"], "left")
    return hit.groupBy(*by).agg(F.count("*").alias("n_true"), F.sum(F.coalesce("hit", F.lit(0))).alias("n_found"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def class_recall(keyed: DataFrame, cands: DataFrame) -> DataFrame:
    """recall() by country where the true pairs are a query and a pool record of equal country and k, without listing them.

    keyed: (id, country, src, k), one row an id; pairs are counted by class, and only candidates are looked at one by one.
    """
    own = keyed.where("country is not null and k is not null")
    true = own.groupBy("country", "k").agg(F.count_if(F.col("src") == "S1").alias("a"), F.count_if(F.col("src") != "S1").alias("b"))
    true = true.groupBy("country").agg(F.sum(F.col("a") * F.col("b")).alias("n_true")).where("n_true > 0")
    of = lambda asked, row, k: own.where((F.col("src") == "S1") == asked).select(F.col("id").alias(row), F.col("country").alias(f"{k}_country"), F.col("k").alias(k))
    both = cands.select("s1_row", "pool_row").join(of(True, "s1_row", "a"), "s1_row").join(of(False, "pool_row", "b"), "pool_row")
    hits = both.where("a = b and a_country = b_country").groupBy(F.col("a_country").alias("country")).agg(F.count("*").alias("found"))
    found = F.coalesce("found", F.lit(0)).cast("long")
    return true.join(hits, "country", "left").select("country", "n_true", found.alias("n_found"), (found / F.col("n_true")).alias("recall"))
