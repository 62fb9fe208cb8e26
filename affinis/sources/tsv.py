"""Record files: tab-separated text read as strings, columnar parts by path pattern, and the plain files that reports go to."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = ("entity_id", "business_name", "business_address", "country")


def read(spark: SparkSession, path: str, columns: tuple[str, ...] = RECORD) -> DataFrame:
    """All columns as strings, quotes taken literally, in one pass over one file, a folder or a pattern of files.

    Every line but the files' headers (which must be the same) is one row, so none can be lost; a line with another
    number of fields than the header fails the read. Empty fields are null.
    """
    lines = spark.read.text(path, lineSep="\n").select(F.regexp_replace("value", "\r$", "").alias("line"))
    first = lines.first()
    names = first[0].split("\t") if first else list(columns)
    fields = F.split("line", "\t", -1)
    wrong = F.raise_error(F.concat(F.lit(f"not {len(names)} fields: "), F.col("line")))
    rows = lines.where((F.col("line") != (first[0] if first else "")) & (F.col("line") != ""))
    rows = rows.select(F.when(F.size(fields) == len(names), fields).otherwise(wrong).alias("f"))
    return rows.select(*[F.nullif(F.get("f", F.lit(names.index(c))), F.lit("")).alias(c) for c in columns if c in names])


def read_parts(spark: SparkSession, pattern: str, columns: list[str]) -> DataFrame:
    """The columns of all Parquet parts that match a path pattern."""
    return spark.read.parquet(pattern).select(*columns)


def write_lists(lists: DataFrame, path: str) -> None:
    """(id, list) rows, in order of the id, never quoted."""
    write_table(lists.orderBy(lists.columns[0]), path)


def write_table(df: DataFrame, path: str) -> None:
    """Metrics, curves and misses as tab-separated text with a header, never quoted; nulls are empty."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A small report as one JSON line; all or nothing."""
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def write_records(df: DataFrame, path: str, by: str = "country") -> None:
    """Parquet by partition value; Spark escapes any value safely and commits all or nothing."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)
