"""New records as a stream against a fixed pool: each micro-batch is blocked and appended (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking


def candidates(arriving: DataFrame, pool: DataFrame, path: str, checkpoint: str, view: str = "W_name", k: int = 5, cap: float = 0.05) -> StreamingQuery:
    """Append the top-k candidates of arriving queries to path, exactly once per batch id.

    The pool is weighed once, when the stream starts; its vocabulary and postings are tables beside the checkpoint.
    """
    spark = pool.sparkSession
    at = {name: f"{checkpoint}-pool/{name}" for name in ("vocab", "postings")}
    vocab = blocking.vocabulary(blocking.tokens(pool.where("src <> 'S1'"), view))
    vocab.write.mode("overwrite").parquet(at["vocab"])
    vocab = spark.read.parquet(at["vocab"])
    blocking.weighted(blocking.tokens(pool.where("src <> 'S1'"), view), vocab, cap).write.mode("overwrite").parquet(at["postings"])
    postings = spark.read.parquet(at["postings"])

    def batch(df: DataFrame, number: int) -> None:
        asked = blocking.weighted(blocking.tokens(df.where("src = 'S1'"), view), vocab, cap)
        blocking.search(asked, postings, k).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arriving.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
