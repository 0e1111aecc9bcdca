"""Best-so-far and running means over a growing folder of examples, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def edge_statistics(stream: DataFrame) -> DataFrame:
    """n and q of each edge (s, a) so far; state is one row an edge."""
    return stream.groupBy("s", "a").agg(F.count("*").alias("n"), F.avg("v").alias("q"))


def windowed_best(stream: DataFrame, late: str = "10 minutes", every: str = "1 hour") -> DataFrame:
    """Best m of each window of event time; rows later than `late` are left out and state is dropped."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", every).alias("w")).agg(F.max("m").alias("m")).select(F.col("w.start").alias("start"), "m")


def follow(spark: SparkSession, folder: str, schema: str, table: str, checkpoint: str) -> StreamingQuery:
    """Keeps the edge statistics of a folder of Parquet files in a memory table."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return edge_statistics(stream).writeStream.outputMode("complete").format("memory").queryName(table).option("checkpointLocation", checkpoint).start()


def follow_best(stream: DataFrame, path: str, checkpoint: str, every: str = "1 hour") -> StreamingQuery:
    """Writes the best of each window of all that a stream of (ts, m) has by now to path.

    Each batch replaces the table with all windows so far, so one that comes again changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return windowed_best(stream, every=every).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
