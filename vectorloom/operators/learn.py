"""Policy and value models from replay examples, fitted by Adam on minibatches with distributed gradient sums."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.operators.collective import Sums

#: What tells examples apart, as far as they have it.
KEYS = ("iter", "rank", "episode", "turn", "id")


def losses(edge: DataFrame, value: float) -> DataFrame:
    """cross_entropy, squared_error: means over states of (s, p, z) with logits z, against a target value."""
    w = W.partitionBy("s")
    logged = edge.withColumn("high", F.max("z").over(w))
    logged = logged.withColumn("lp", F.col("z") - F.col("high") - F.log(F.sum(F.exp(F.col("z") - F.col("high"))).over(w)))
    by_state = logged.groupBy("s").agg((-F.sum(F.col("p") * F.col("lp"))).alias("ce"), F.pow(F.sum(F.col("p") * F.col("z")) - value, 2).alias("se"))
    return by_state.agg(F.avg("ce").alias("cross_entropy"), F.avg("se").alias("squared_error"))


def board_features(m: int, partial: list[float], gram: list[float]) -> np.ndarray:
    """A fixed-length description of a state: sizes, the partial cosines' statistics and the Gram matrix's histogram."""
    g = np.asarray(gram, dtype=np.float64)
    bins = np.histogram(g, bins=[-1.01, -0.75, -0.25, -0.05, 0.05, 0.25, 0.45, 0.55, 1.01])[0] / max(1, len(g))
    p = np.asarray(partial, dtype=np.float64)
    return np.array([1.0, m / 100, len(p) / 10, p.sum() if len(p) else 0.0, p[-1] if len(p) else 0.0, *bins])


def forward(weights: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    z = x @ weights["policy"]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True), x @ weights["value"]


def uniform(*parts: Column) -> Column:
    """A number from 0 to under 1 by md5 of the parts, the same in other engines."""
    name = F.concat_ws(":", *(x.cast("string") for x in parts))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32


def minibatches(examples: DataFrame, size: int, epochs: int, seed: int) -> tuple[DataFrame, int]:
    """examples with epoch and step, and the steps of an epoch: each step has about `size` rows, drawn with replacement.

    A row is drawn a Poisson number of times an epoch, and each draw goes to a random step, which is
    what drawing `size` rows for every step comes to, in one pass over the examples. Draws are hashes of
    the seed, the epoch and the row's KEYS (all columns where it has none of them).
    """
    n = examples.count()
    size = min(size, n)
    steps = n // size if n else 0
    key = [F.col(k) for k in KEYS if k in examples.columns] or [F.to_json(F.struct("*"))]
    each = examples.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")).withColumn("u", uniform(F.lit(seed), F.col("epoch"), *key))
    drawn = each.withColumn("draws", F.size(F.filter(F.array(*map(F.lit, poisson(steps * size / n if n else 0.0))), lambda x: x <= F.col("u")))).filter("draws > 0")
    own = drawn.select("*", F.explode(F.sequence(F.lit(1), F.col("draws"))).alias("draw"))
    at = uniform(F.lit(seed + 1), F.col("epoch"), *key, F.col("draw")) * max(1, steps)
    return own.withColumn("step", F.floor(at).cast("int")).drop("u", "draws", "draw"), steps


def poisson(rate: float) -> list[float]:
    """The chances of at most 0, 1, ... 11 draws."""
    return np.cumsum([math.exp(-rate) * rate**k / math.factorial(k) for k in range(12)]).tolist()


@dataclass
class Fit:
    """Linear policy (softmax) and value heads; epoch, cross entropy and squared error of each epoch's batches; the first step's mean gradient."""

    weights: dict[str, np.ndarray]
    history: list[tuple[int, float, float]]
    gradient: np.ndarray


def fit_vectors(vectors: DataFrame, wide: int, actions: int, epochs: int = 10, rate: float = 1e-3, batch: int = 256, seed: int = 0, workers: int | None = None, most_steps: int | None = None) -> Fit:
    """A fit of examples (x, pi, reward and KEYS) by Adam on minibatches, in one barrier stage.

    Every task holds its share of all minibatches, sorted by epoch and step, and reads it once. At each
    step tasks add up their gradient sums (a number a weight) and take the same step, so there is no job, folder
    or driver between steps. A lost executor runs the stage again, with the same draws. The cluster must have
    `workers` free slots. Without examples the weights stay 0.
    """
    spark, size = vectors.sparkSession, wide * actions + wide
    drawn, steps = minibatches(vectors, batch, epochs, seed)
    if not steps:
        return Fit(heads(np.zeros(size), wide, actions), [], np.zeros(size))
    workers = workers or spark.sparkContext.defaultParallelism

    def run(batches):
        from pyspark import BarrierTaskContext

        context, shares = BarrierTaskContext.get(), by_step(batches)
        weights, m, v, t = np.zeros(size), np.zeros(size), np.zeros(size), 0
        ahead, lost = next(shares, None), np.zeros((epochs, 3))
        first = np.zeros(size)
        with Sums(context) as sums:
            for epoch, step in itertools.islice(itertools.product(range(epochs), range(steps)), most_steps):
                own = np.zeros(size + 3)
                if ahead is not None and ahead[0] == (epoch, step):
                    own, ahead = slopes(heads(weights, wide, actions), *ahead[1:]), next(shares, None)
                total = sums.total(own)
                if not total[-1]:
                    continue
                slope, t = total[:size] / total[-1], t + 1
                lost[epoch] += total[size:]
                first = slope if t == 1 else first
                m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
                weights = weights - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        if context.partitionId() == 0:
            yield pd.DataFrame({"weights": [weights], "gradient": [first], "losses": [lost.ravel()]})

    dealt = drawn.select("epoch", "step", "x", "pi", "reward").repartition(workers).sortWithinPartitions("epoch", "step")
    found = dealt.mapInPandas(run, "weights array<double>, gradient array<double>, losses array<double>", barrier=True).collect()[0]
    lost = np.array(found.losses).reshape(epochs, 3)
    history = [(e, float(x[0] / x[2]), float(x[1] / x[2])) for e, x in enumerate(lost) if x[2]]
    return Fit(heads(np.array(found.weights), wide, actions), history, np.array(found.gradient))


def by_step(batches):
    """((epoch, step), x, pi, reward) of a sorted stream: one minibatch's rows at a time, slices of a batch's arrays."""
    key, held = None, []
    for b in batches:
        if not len(b):
            continue
        epoch, step = b["epoch"].to_numpy(), b["step"].to_numpy()
        own = np.stack(b["x"].to_numpy()), np.stack(b["pi"].to_numpy()), b["reward"].to_numpy(dtype=np.float64)
        first = np.flatnonzero(np.concatenate([[True], (epoch[1:] != epoch[:-1]) | (step[1:] != step[:-1])])).tolist()
        for i, j in zip(first, [*first[1:], len(b)], strict=True):
            now = int(epoch[i]), int(step[i])
            if now != key and held:
                yield (key, *joined(held))
                held = []
            key = now
            held.append([x[i:j] for x in own])
    if held:
        yield (key, *joined(held))


def joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    return held[0] if len(held) == 1 else [np.concatenate(x) for x in zip(*held, strict=True)]


def heads(weights: np.ndarray, wide: int, actions: int) -> dict[str, np.ndarray]:
    return {"policy": weights[: wide * actions].reshape(wide, actions), "value": weights[wide * actions :]}


def slopes(weights: dict[str, np.ndarray], x: np.ndarray, pi: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Sums over examples: the slopes of cross entropy and squared error, both losses, and the number of rows."""
    p, v = forward(weights, x)
    return np.concatenate([(x.T @ (p - pi)).ravel(), 2 * x.T @ (v - z), [-(pi * np.log(p + 1e-12)).sum(), ((v - z) ** 2).sum(), len(x)]])


def board_vectors(examples: DataFrame) -> DataFrame:
    """KEYS, x, pi, reward of replay examples (m, partial, gram, pi, reward), by board_features()."""
    examples = examples.withColumnsRenamed({"step": "turn"})  # a minibatch has a step of its own
    keys = [k for k in KEYS if k in examples.columns]
    kinds = dict(examples.dtypes)

    def run(batches):
        for b in batches:
            yield b[keys].assign(x=[board_features(*row) for row in zip(b["m"], b["partial"], b["gram"], strict=True)], pi=b["pi"], reward=b["reward"])

    return examples.select(*keys, "m", "partial", "gram", "pi", "reward").mapInPandas(run, "".join(f"{k} {kinds[k]}, " for k in keys) + "x array<double>, pi array<double>, reward double")


def fit(examples: DataFrame, actions: int, epochs: int = 10, rate: float = 1e-3, batch: int = 256, seed: int = 0) -> tuple[dict[str, np.ndarray], list[tuple[int, float, float]]]:
    """Weights and history of a fit of replay examples."""
    found = fit_vectors(board_vectors(examples), len(board_features(0, [], [])), actions, epochs, rate, batch, seed)
    return found.weights, found.history


def fitted_losses(examples: DataFrame, wide: int, actions: int, epochs: int = 5) -> DataFrame:
    """epoch, cross_entropy, squared_error of a fit of vectors."""
    history = fit_vectors(examples, wide, actions, epochs).history
    return examples.sparkSession.createDataFrame(history, "epoch int, cross_entropy double, squared_error double")


def first_gradient(examples: DataFrame, wide: int, actions: int) -> DataFrame:
    """head, feature, action (null for values), slope: the mean gradient of the first minibatch."""
    found = heads(fit_vectors(examples, wide, actions, 1, most_steps=1).gradient, wide, actions)
    rows = [("policy", i, a, float(found["policy"][i, a])) for i in range(wide) for a in range(actions)] + [("value", i, None, float(found["value"][i])) for i in range(wide)]
    return examples.sparkSession.createDataFrame(rows, "head string, feature int, action int, slope double")


def evaluator(weights: dict[str, np.ndarray]):
    """An evaluator for self-play from fitted weights."""

    def evaluate(state):
        p, v = forward(weights, board_features(state.m, list(state.partial), state.gram.ravel())[None])
        return p[0], float(v[0])

    return evaluate


def predictions(states: DataFrame, weights: dict[str, np.ndarray], *keys: str) -> DataFrame:
    """keys, pi, value for batches of states (m, partial, gram); the weights are broadcast."""
    shared = states.sparkSession.sparkContext.broadcast(weights)
    kinds = dict(states.dtypes)

    def run(batches):
        for b in batches:
            if len(b):
                p, v = forward(shared.value, np.stack([board_features(*row) for row in zip(b["m"], b["partial"], b["gram"], strict=True)]))
                yield b[list(keys)].assign(pi=list(p), value=v)

    return states.select(*keys, "m", "partial", "gram").mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", pi array<double>, value double")


def predict_vectors(vectors: DataFrame, weights: dict[str, np.ndarray], *keys: str) -> DataFrame:
    """keys, pi, value of vectors (x); the weights are broadcast."""
    shared = vectors.sparkSession.sparkContext.broadcast(weights)
    kinds = dict(vectors.dtypes)

    def run(batches):
        for b in batches:
            if len(b):
                p, v = forward(shared.value, np.stack(b["x"].to_numpy()))
                yield b[list(keys)].assign(pi=list(p), value=v)

    return vectors.select(*keys, "x").mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", pi array<double>, value double")


def shuffled(examples: DataFrame, seed: int) -> DataFrame:
    return examples.orderBy(F.rand(seed))
