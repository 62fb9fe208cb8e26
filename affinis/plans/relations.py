"""Record and candidate relations over the standard tables: the stand-ins that every catalogue query starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME_TOKENS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _side(number: Column) -> Column:
    """Every fourth record is a query; the others are the two sources of the pool."""
    return F.when(number % 4 == 0, "S1").when(number % 4 == 3, "S3").otherwise("S2")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, country, src, name, addr): documents as records. name: the first words of a text; addr: all its others."""
    words = lambda c: F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    start = rf"^[^\p{{L}}\p{{N}}]*+(?:[\p{{L}}\p{{N}}]++[^\p{{L}}\p{{N}}]++){{0,{NAME_TOKENS - 1}}}+[\p{{L}}\p{{N}}]*+"
    name = words(F.regexp_extract(F.lower("text"), start, 0))  # what only needs the name looks for no other words
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("country"), _side(F.col("doc_id")).alias("src"), name.alias("name"), words(F.lower("text")).alias("t"))
    return docs.select("id", "country", "src", "name", F.slice("t", F.lit(NAME_TOKENS + 1), F.greatest(F.size("t"), F.lit(0))).alias("addr"))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, country, src, name, addr): pages as records. name: the words of a page's title; addr: those of its url."""
    words = lambda c: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    title, lang = (F.regexp_extract("html", p, 1) for p in (r"(?is)<title>(.*?)</title>", r'(?i)<html[^>]*\slang="([^"]*)"'))
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.coalesce(lang, F.lit("")).alias("country"), _side(F.col("page_id")).alias("src"), words(title).alias("name"), words(F.col("url")).alias("addr"))


def scored(spark: SparkSession, sf_dir: str, contended: bool = True) -> DataFrame:
    """(s1_row, pool_row, p, label): line items as scored pairs; contended: many queries want one pool row."""
    pool = F.col("l_partkey") if contended else F.col("l_partkey") * 1000 + F.col("l_suppkey")
    pairs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("s1_row"), pool.alias("pool_row"), "l_partkey").agg(F.max("l_suppkey").alias("s"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("label"))
    p = ((F.col("s") * 31 + F.col("l_partkey") * 17 + F.col("s1_row") * 7) % 1000) / 1000.0
    return pairs.select("s1_row", "pool_row", p.alias("p"), "label")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_row, country): every query, those without candidates too; the country is the customer's region."""
    t = lambda n: table(spark, sf_dir, n)
    place = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("country"))
    who = t("customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")
    return t("orders").join(who, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_orderkey").alias("s1_row"), "country")


def truth(pairs: DataFrame, queries: DataFrame) -> DataFrame:
    """(s1_row, country, n_gt, n_gtc): links that exist, and those among the candidates; every seventh query misses one."""
    found = pairs.groupBy("s1_row").agg(F.sum("label").cast("long").alias("n_gtc"))
    own = queries.join(found, "s1_row", "left").withColumn("n_gtc", F.coalesce("n_gtc", F.lit(0)).cast("long"))
    return own.select("s1_row", "country", (F.col("n_gtc") + (F.col("s1_row") % 7 == 0).cast("long")).alias("n_gt"), "n_gtc")
