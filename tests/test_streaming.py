from pyspark.sql import functions as F

from vectorloom.operators import search
from vectorloom.streaming import replay


def test_stream_and_batch_agree(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 7).alias("s"), (F.col("id") % 3).cast("int").alias("a"), (F.col("id") / 10).alias("v"))
    folder = str(tmp_path / "in")
    rows.filter("s < 4").write.parquet(folder)
    query = replay.follow(spark, folder, "s long, a int, v double", "edges_now", str(tmp_path / "check"))
    query.processAllAvailable()
    rows.filter("s >= 4").write.mode("append").parquet(folder)
    query.processAllAvailable()
    query.stop()
    key = lambda r: (r.s, r.a)
    got, want = sorted(spark.table("edges_now").collect(), key=key), sorted(search.edges(rows).collect(), key=key)
    assert [(r.s, r.a, r.n, round(r.q, 9)) for r in got] == [(r.s, r.a, r.n, round(r.q, 9)) for r in want]
