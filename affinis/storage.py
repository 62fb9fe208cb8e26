"""Tables in the folder that driver and executors share: they cut lineage, and their shuffle files go when they are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share: spark.checkpoint.dir of the session.

    Where that is unset, a session on one machine (master local) gets a folder of its own; any other must set it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = sc.getConf().get("spark.checkpoint.dir")
        if not path and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that start in this block delete their shuffle files when they end, not at the driver's next collection."""
    was = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, was)


def stored(df: DataFrame, codec: str = "snappy", by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it from there: lineage ends, so lost executors cost no recomputation.

    by: a column that has a folder for each of its values, so that a filter on it opens no other files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with _shuffles_go(spark):
        df.write.parquet(path, compression=codec, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def together(tables: list[DataFrame]) -> DataFrame:
    """The rows of stored tables of one schema as one table."""
    folders = sorted(set().union(*map(_folders, tables)))
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*folders) if folders else tables[0]


def dropped(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for file in _folders(df):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
