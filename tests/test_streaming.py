"""Records that arrive as a stream get the candidates that a batch over the same pool gives."""

from affinis.operators.blocking import top_k
from affinis.plans.relations import records
from affinis.streaming.incremental import candidates


def test_stream_equals_batch(spark, tmp_path):
    all_ = records(spark, "/root/testdata/sf0.001")
    all_.where("src = 'S1'").repartition(2).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(all_.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = candidates(arriving, all_, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    got = {(r.s1_row, r.pool_row, r["rank"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(r.s1_row, r.pool_row, r["rank"]) for r in top_k(all_, "W_name", 5).collect()}
