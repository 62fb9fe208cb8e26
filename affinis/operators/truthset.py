"""Ground truth: explosion of id lists, diagnostics, share-preserving samples and disjoint splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exploded(df: DataFrame, id_col: str, list_col: str) -> DataFrame:
    """(id, match) of a comma list; null and empty lists give no row."""
    ids = F.split(F.coalesce(F.col(list_col), F.lit("")), ",")
    return df.select(F.col(id_col).alias("id"), F.explode(ids).alias("match")).select("id", F.trim("match").alias("match")).where("match <> ''")


def order_key(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def stratified(df: DataFrame, n: int, by: str, key: str, seed: str) -> DataFrame:
    """About n rows, each stratum with its share (rounded half to even), in a fixed pseudo-random order."""
    sizes = df.groupBy(by).agg(F.count("*").alias("size"))
    total = df.agg(F.count("*").alias("total"))
    quota = sizes.join(total.withColumn("one", F.lit(1)), F.lit(1) == F.col("one")).select(F.col(by).alias("stratum"), F.bround(F.lit(n) * F.col("size") / F.col("total")).cast("long").alias("quota"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order_key(F.col(key), seed), key))
    return df.withColumn("pick", rank).join(quota, F.col(by).eqNullSafe(F.col("stratum"))).where("pick <= quota").select(*df.columns)


def splits(df: DataFrame, train: int, val: int, early: int, holdout: int, by: str, key: str) -> DataFrame:
    """(key, by, split): train, early (part of train), val (disjoint from train), holdout (outside both)."""
    held = stratified(df, train + val, by, key, "held")
    fit = stratified(held, train, by, key, "train")
    rest = df.join(held.select(key), key, "left_anti")
    parts = {"train": fit, "val": held.join(fit.select(key), key, "left_anti"), "early": stratified(fit, early, by, key, "early"), "holdout": stratified(rest, holdout, by, key, "holdout")}
    out = None
    for name, part in parts.items():
        part = part.select(key, by, F.lit(name).alias("split"))
        out = part if out is None else out.unionByName(part)
    return out


def contested(pairs: DataFrame) -> DataFrame:
    """(pool_row, owners): pool rows that more than one query truly has."""
    return pairs.where("label = 1").groupBy("pool_row").agg(F.countDistinct("s1_row").alias("owners")).where("owners > 1")


def injective(pairs: DataFrame, limit: float = 0.001) -> DataFrame:
    """One row: contested pool rows, true pairs, and whether so few are contested that matches are one to one."""
    true = pairs.where("label = 1").agg(F.count("*").alias("n_pairs"))
    few = contested(pairs).agg(F.count("*").alias("n_contested"))
    both = true.withColumn("one", F.lit(1)).join(few, F.lit(1) == F.col("one"))
    return both.select("n_pairs", "n_contested", (F.col("n_contested") < limit * F.col("n_pairs")).alias("injective"))
