"""Queries of this subpackage, with their DuckDB forms where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import neardup, packing, pieces, quality, secrets, sql, suffixes, suffixtree, topk, toxicity, urls
from .common import table


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, "doc_id", "text", F.col("toxic"))
    return toxicity.score(docs, model).withColumn("toxic", toxicity.rejected(F.col("p_toxic"))).withColumnRenamed("id", "doc_id")


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    back = pieces.decode(pieces.encode(docs))
    text_hash = F.xxhash64("text")
    return back.select(F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.length("text").cast("long").alias("n_chars"), text_hash.alias("decoded_hash"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, "doc_id", "text", F.col("source"), F.concat_ws("/", "source", "lang")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).withColumnRenamed("id", "doc_id")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = suffixtree.crc_fold("doc_id") == 2
    train = docs.where(~out)
    return suffixtree.score(docs, suffixtree.grow(train), held_out=out).withColumnRenamed("id", "doc_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_top_k, op2_toxicity, op3_sentence_pieces, op4_packing, op5_secret_scan, op6_quality_rules, op7_url_filter, op8_near_duplicates, op9_suffix_array, op10_suffix_tree, pipeline)}
ORACLES: dict[str, str] = {
    "op5_secret_scan": sql.SECRETS,
    "op6_quality_rules": sql.QUALITY,
    "op1_top_k": """
        with fine as (
            select vec_id, min([cast(floor(1024 * cast(x as double)) as bigint) for x in embedding]) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            group by vec_id),
        flat as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as i from fine),
        scored as (
            select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
            from flat q join flat c on q.i = c.i and q.vec_id <> c.vec_id
            where q.vec_id % 100 = 0 group by all),
        ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
        select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10""",
    "op8_near_duplicates": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
        shingles as (
            select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
        links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
        reach as (
            select doc_id as d, doc_id as r from documents
            union select reach.d, links.b from reach join links on links.a = reach.r)
        select d.doc_id, coalesce(s.n, 0) as n_shingles, min(r.r) as component_id, min(r.r) = d.doc_id as kept
        from documents d join reach r on r.d = d.doc_id left join sizes s on s.doc_id = d.doc_id group by d.doc_id, s.n""",
}
