"""The corpus pipeline: toxicity, near-duplicates, repeated passages, secrets, packing.

Each stage works on all that its predecessor kept; the first four return the columns of documents, the last the packed
pieces. Documents that the toxicity model rejects go; of each group of near duplicates the smallest id stays; passages
that repeat are cut out of the texts, which no longer count them; secrets are blotted out; what is left is packed.

Nulls and edge cases: a null or empty text is kept and packed as its end token alone; rows without an id are never near
duplicates of others; of rows that repeat an id one stays; other columns pass unchanged, whatever their names, but for
n_chars, which follows the text; empty documents give empty stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import neardup, packing, secrets, suffixes, toxicity
from affinis.llm.common import shared_folder, table

#: Near duplicates of the stage: word shingles that agree from this similarity on.
PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", F.col("toxic"))
    return toxicity.without_rejected(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_copies(docs, percent=PERCENT)


def repeated_passages_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.dedup_texts(docs)


def secrets_are_blotted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_documents_go), ("near_duplicates", one_of_each_group), ("suffix_array", repeated_passages_go),
    ("secrets", secrets_are_blotted), ("packing", packed),
]

#: SQL has no form for the models, suffix arrays and tokens of the stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
