"""Metrics of iterations as a streaming sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from vectorloom.sources.tables import read_store


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that adds a batch's parts of each iteration's metrics.

    A batch is a partition of its own, which it replaces when it comes again, so a batch that is
    replayed after a failure adds nothing. Parts are sums, counts and maxima, which can be added up.
    """

    def write(batch: DataFrame, number: int) -> None:
        parts = batch.groupBy("iter").agg(F.max("m").alias("best"), F.sum("m").alias("total"), F.count("*").alias("steps"))
        parts.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return write


def follow_metrics(steps: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes all that a stream of (iter, m) has by now, in as many batches as its source makes."""
    return steps.writeStream.foreachBatch(batch_writer(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """iter, name, value of best, mean and steps over all batches."""
    each = read_store(spark, path).groupBy("iter").agg(F.max("best").alias("best"), (F.sum("total") / F.sum("steps")).alias("mean"), F.sum("steps").cast("double").alias("steps"))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("best", "mean", "steps")))).alias("x")
    return each.select("iter", rows).select("iter", "x.name", "x.value")


class Progress(StreamingQueryListener):
    """Gives (batch, rows, milliseconds) of every batch of a session's streams to a function."""

    def __init__(self, tell: Callable[[int, int, int], None]):
        self.tell = tell

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.tell(p.batchId, p.numInputRows, p.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
