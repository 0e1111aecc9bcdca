"""Tree-search statistics over an edge trace: visits, backups, policies, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.functions.columns import upper_confidence


def edges(trace: DataFrame) -> DataFrame:
    """s, a, n, q: visits and mean value of each edge of (s, a, v)."""
    return trace.groupBy("s", "a").agg(F.count("*").alias("n"), F.avg("v").alias("q"))


def running_backup(trace: DataFrame) -> DataFrame:
    """The mean and the count of each edge after each of its visits, in order of sim."""
    w = W.partitionBy("s", "a").orderBy("sim").rowsBetween(W.unboundedPreceding, W.currentRow)
    return trace.withColumn("n", F.count("*").over(w)).withColumn("q", F.avg("v").over(w))


def expanded(states: DataFrame, edge: DataFrame, actions: DataFrame) -> DataFrame:
    """Every state with every action, and the edge's statistics where it was visited. actions is the alphabet, a few rows."""
    return states.join(F.broadcast(actions), how="cross").join(edge, ["s", "a"], "left")


def policy(edge: DataFrame, temperature: float) -> DataFrame:
    """p beside the edge's columns: visits to the power 1/temperature, as shares of the state's."""
    weight = F.pow(F.col("n").cast("double"), F.lit(1 / temperature))
    return edge.withColumn("p", weight / F.sum(weight).over(W.partitionBy("s")))


def greedy(edge: DataFrame) -> DataFrame:
    """s, a: the most visited action, the smallest on ties."""
    return edge.groupBy("s").agg(F.min_by("a", F.struct(-F.col("n"), "a")).alias("a"))


def with_fallback(full: DataFrame) -> DataFrame:
    """Policy over all actions of (s, a, n, valid): visits, else uniform over valid ones, else uniform over all."""
    w = W.partitionBy("s")
    visits, legal = F.sum(F.coalesce("n", F.lit(0))).over(w), F.sum(F.col("valid").cast("int")).over(w)
    share = F.when(visits > 0, F.coalesce("n", F.lit(0)) / visits).when(legal > 0, F.col("valid").cast("double") / legal).otherwise(F.lit(1.0) / F.count("*").over(w))
    return full.select("s", "a", share.alias("p"))


def selection(full: DataFrame, c: float = 2.0) -> DataFrame:
    """s, a, u: the action of greatest upper confidence of (s, a, n, q, prior), the smallest on ties."""
    visits = F.sum(F.coalesce("n", F.lit(0))).over(W.partitionBy("s"))
    scored = full.withColumn("u", F.round(upper_confidence(F.col("q"), F.col("n"), F.col("prior"), visits, c), 6))
    return scored.groupBy("s").agg(F.max(F.struct("u", (-F.col("a")).alias("a"))).alias("m")).select("s", (-F.col("m.a")).alias("a"), "m.u")


def unexpanded(states: DataFrame, nodes: DataFrame) -> DataFrame:
    return states.join(nodes, "s", "left_anti")


def repeats(path: DataFrame, look_back: int = 10, past: int = 5) -> DataFrame:
    """Whether a step's state is among the last ten of its path, past the fifth step."""
    order = W.partitionBy("path").orderBy("step")
    recent = F.collect_list("s").over(order.rowsBetween(-look_back, -1))
    return path.withColumn("repeat", (F.row_number().over(order) > past) & F.array_contains(recent, F.col("s")))


def sampled(policy_frame: DataFrame, draw: Column) -> DataFrame:
    """s, a: the first action at which the running share passes a draw in [0, 1) for the state."""
    w = W.partitionBy("s").orderBy("a")
    running = policy_frame.withColumn("upto", F.sum("p").over(w)).withColumn("draw", draw).withColumn("last", F.max("a").over(W.partitionBy("s")))
    return running.filter((F.col("upto") > F.col("draw")) | (F.col("a") == F.col("last"))).groupBy("s").agg(F.min("a").alias("a"))
