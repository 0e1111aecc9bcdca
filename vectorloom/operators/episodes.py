"""Episode and replay-window analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.functions.columns import reward


def running_best(steps: DataFrame) -> DataFrame:
    """best: the greatest m among the live steps so far, from 1 on."""
    w = W.partitionBy("episode").orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
    alive = F.max(F.when(~F.col("is_dead"), F.col("m"))).over(w)
    return steps.withColumn("best", F.greatest(F.lit(1.0), F.coalesce(alive, F.lit(1.0))))


def best_by(results: DataFrame, *keys: str) -> DataFrame:
    """The first of the best results of each group: greatest m, then smallest rank and episode. Partial maxima, no sort."""
    best = F.max(F.struct("m", (-F.col("rank")).alias("rank"), (-F.col("episode")).alias("episode"))).alias("x")
    grouped = results.groupBy(*keys).agg(best) if keys else results.agg(best)
    others = [k for k in keys if k not in ("rank", "episode")]
    return grouped.select(*others, (-F.col("x.rank")).alias("rank"), (-F.col("x.episode")).alias("episode"), F.col("x.m").alias("m"))


def improvements(iterations: DataFrame) -> DataFrame:
    """best, improved over (iter, m), one row an iteration: strict improvements on all before."""
    before = F.max("m").over(W.orderBy("iter").rowsBetween(W.unboundedPreceding, -1))
    return iterations.select("iter", "m", F.greatest("m", F.coalesce(before, F.col("m"))).alias("best"), (before.isNull() | (F.col("m") > before)).alias("improved"))


def retained(examples: DataFrame, keep: int) -> DataFrame:
    """Examples of the last `keep` iterations. The iterations are found first; `keep` of them at most are sent to tasks."""
    last = examples.select("iter").distinct().orderBy(F.desc("iter")).limit(keep)
    return examples.join(F.broadcast(last), "iter", "left_semi")


def with_reward(steps: DataFrame, low: float, high: float) -> DataFrame:
    """Every step with the reward of its episode's last value."""
    last = steps.groupBy("episode").agg(F.max_by("m", "step").alias("last"))
    return steps.join(last.select("episode", reward(F.col("last"), low, high).alias("reward")), "episode")


def with_temperature(steps: DataFrame, threshold: int) -> DataFrame:
    nth = F.row_number().over(W.partitionBy("episode").orderBy("step"))
    return steps.withColumn("nth", nth).withColumn("temperature", F.when(F.col("nth") < threshold, 1).otherwise(0))


def meter(values: DataFrame, *keys: str) -> DataFrame:
    """Weighted sum, count and average of (value, weight)."""
    w = F.sum("weight")
    return values.groupBy(*keys).agg(F.sum(F.col("value") * F.col("weight")).alias("sum"), w.alias("count"), F.try_divide(F.sum(F.col("value") * F.col("weight")), w).alias("avg"))


def symmetries(examples: DataFrame, *images: Column) -> DataFrame:
    """examples with their images (columns of the board's type) as boards of their own; without any, as they are: the one form is canonical."""
    if not images:
        return examples
    return examples.withColumn("gram", F.explode(F.array("gram", *images)))


def progress(results: DataFrame, rows: int = 10) -> DataFrame:
    """best_m and the top left block of the best result's Gram matrix (flat), of `rows` rows at most."""
    best = results.orderBy(F.desc("best_m"), "rank", "episode").limit(1)
    size = F.least(F.lit(rows), F.col("best_m").cast("int"))
    block = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.slice("gram", i * F.col("best_m").cast("int") + 1, size))
    return best.select("best_m", block.alias("block"))
