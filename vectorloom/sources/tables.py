"""Parquet sources, and the replay, metrics and model stores of a training run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingStore(FileNotFoundError):
    """A store that was never written, named by its path."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_store(spark: SparkSession, name: str) -> str:
    """A path of its own in the session's shared folder; only where there is none (local tests) in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp()
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """Computes a frame once and cuts its lineage with a reliable checkpoint in the session's shared folder."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(frame.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp())
    return frame.checkpoint(eager=True)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise MissingStore(path) from error
        raise


def append_replay(examples: DataFrame, path: str) -> None:
    """Adds examples of an iteration: one partition folder an iteration, so that retention prunes folders."""
    examples.write.mode("append").partitionBy("iter").parquet(path)


def read_replay(spark: SparkSession, path: str, keep: int, upto: int) -> DataFrame:
    """Examples of the last `keep` iterations up to `upto`: a partition filter, other folders are not read."""
    return read_store(spark, path).filter((F.col("iter") > upto - keep) & (F.col("iter") <= upto))


def append_metrics(spark: SparkSession, path: str, iteration: int, **values: float) -> None:
    rows = [(iteration, k, float(v)) for k, v in sorted(values.items())]
    spark.createDataFrame(rows, "iter int, name string, value double").coalesce(1).write.mode("append").parquet(path)


def append_metrics_of(iterations: DataFrame, path: str) -> None:
    """Adds the columns of (iter, ...) as metrics: one row an iteration and column."""
    names = sorted(c for c in iterations.columns if c != "iter")
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names))).alias("x")
    iterations.select(F.col("iter").cast("int").alias("iter"), rows).select("iter", "x.name", "x.value").write.mode("append").parquet(path)


def checkpoint_names(iteration: Column, improved: Column, every: int = 10) -> Column:
    """Names of the checkpoints written after an iteration: temp always, best_ever on improvement, a numbered one every ten."""
    numbered = F.when(iteration % every == 0, F.concat(F.lit("checkpoint_"), iteration.cast("string")))
    return F.array_compact(F.array(F.lit("temp"), F.when(improved, F.lit("best_ever")), numbered))


def save_model(spark: SparkSession, path: str, iteration: int, name: str, weights: dict[str, list[float]]) -> None:
    rows = [(iteration, name, k, [float(x) for x in v]) for k, v in weights.items()]
    spark.createDataFrame(rows, "iter int, name string, part string, weights array<double>").coalesce(1).write.mode("append").parquet(path)


def load_model(spark: SparkSession, path: str, name: str) -> dict[str, list[float]]:
    """The newest weights under a name; a model has a few parts, so they fit the driver."""
    own = read_store(spark, path).filter(F.col("name") == name)
    newest = own.agg(F.max("iter").alias("iter")).filter("iter is not null")
    found = own.join(newest, "iter").select("part", "weights").collect()
    if not found:
        raise MissingStore(f"{path}: {name}")
    return {r.part: list(r.weights) for r in found}
