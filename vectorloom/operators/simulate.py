"""Continuous packing: candidates by gradient, greedy acceptance, and discovery of an alphabet and a seed.

All rounds go on together. A step is one job: candidates are rows that tasks solve against
the spheres of their round, and acceptance reads each round's candidates in their order.
What a step broadcasts and brings back is bounded by rounds * (cap + 10) spheres.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions.columns import snapped_entry
from vectorloom.operators import gram as G
from vectorloom.operators.geometry import volume_bases
from vectorloom.sources.tables import stored

TOUCH, SLACK, NEAR = 0.5, 1e-4, 0.1
#: Spheres accepted in a step at most; the step without one, in a row, that ends a round.
AT_ONCE, EMPTY = 10, 6


def start_spheres(spark: SparkSession, dim: int) -> DataFrame:
    rest = [0.0] * (dim - 2)
    return spark.createDataFrame([(0, [1.0, 0.0, *rest]), (1, [0.5, 0.75**0.5, *rest])], "sphere_id int, v array<double>")


def solved(spheres: np.ndarray, x: np.ndarray, steps: int = 150) -> np.ndarray:
    """Unit vectors moved to touch the set without overlap: Adam on the overlap, drawn to the nearest sphere while there are few."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        unit = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-8)
        cos = unit @ spheres.T
        slope = (200 * np.maximum(cos - TOUCH, 0)) @ spheres
        if len(spheres) < 2 * x.shape[1]:
            slope -= 0.1 * spheres[cos.argmax(axis=1)]
        slope -= (slope * unit).sum(axis=1, keepdims=True) * unit
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        x = unit - 0.05 * 0.5 * (1 + np.cos(np.pi * (t - 1) / steps)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def candidates(spark: SparkSession, spheres: dict[int, list[list[float]]], step: int, number: int = 1024, steps: int = 150) -> DataFrame:
    """round, turn, v: of `number` random unit vectors a round those that end up touching its spheres, in random turns.

    A vector is drawn from its round's seed, the step and its own number, so a task that runs again draws the same.
    """
    shared = spark.sparkContext.broadcast({k: np.array(v) for k, v in spheres.items()})
    names = sorted(spheres)

    def run(batches):
        for batch in batches:
            for place, own in batch.groupby(batch["id"] // number):
                k = names[int(place)]
                drawn = [np.random.default_rng([k * 999 + 1, step, i]) for i in (own["id"] % number).tolist()]
                now = shared.value[k]
                x = solved(now, np.stack([r.normal(size=now.shape[1]) for r in drawn]), steps)
                most = (x @ now.T).max(axis=1)
                good = (most <= TOUCH + SLACK) & (most >= TOUCH - NEAR)
                turn = np.array([r.random() for r in drawn])
                if good.any():
                    yield pd.DataFrame({"round": np.int64(k), "turn": turn[good], "v": list(x[good])})

    return spark.range(len(names) * number).mapInPandas(run, "round long, turn double, v array<double>")


def accepted(offered: DataFrame, order: str, touch: float = TOUCH + SLACK, most: int = AT_ONCE) -> DataFrame:
    """round, place and the other columns of offered (round, v, ...): those taken greedily in order, `most` a round at most.

    Each must overlap with none that its round took before. A round is one task's sorted stream, so this is for
    the bounded numbers of candidates of packing; first_independent() takes rounds of any size. Null vectors are left out.
    """
    names = offered.columns

    def run(batches):
        now, taken = None, []
        for batch in batches:
            for k, own in batch.groupby("round", sort=False):
                if k != now:
                    now, taken = k, []
                first = len(taken)
                picks = greedy(own["v"], taken, touch, most)
                if picks:
                    yield own.iloc[picks].assign(place=np.arange(first, len(taken), dtype=np.int32))[["place", *names]]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in offered.schema)
    return offered.filter("v is not null").repartition("round").sortWithinPartitions("round", order).mapInPandas(run, f"place int, {kinds}")


def first_independent(offered: DataFrame, order: str, touch: float = TOUCH + SLACK, most: int = AT_ONCE) -> DataFrame:
    """accepted() for rounds of any size: a round's rows may lie in many partitions, and none is read by one task.

    Rows are ranges of (round, order); order must differ within a round, and null vectors are left out. In each pass
    every partition offers what it would take by itself, `most` a round at most. Read in order, such a
    choice is final as long as none before it was knocked out: until then nothing undecided stands before it. Rows that
    overlap with what became final, and those of full rounds, are dropped, and the rest goes on. The first choice
    of a round is always final, so there are no more than `most` passes, and two where partitions do not meddle.
    """
    spark, names = offered.sparkSession, offered.columns
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in offered.schema)
    ranged = offered.filter("v is not null").repartitionByRange(parts, "round", order).sortWithinPartitions("round", order)
    left = stored(ranged.withColumn("part", F.spark_partition_id()))
    taken = spark.createDataFrame([], f"place int, {kinds}")

    def offer(batches):
        now, free = None, []
        for batch in batches:
            for k, own in batch.groupby("round", sort=False):
                if k != now:
                    now, free = k, []
                picks = greedy(own["v"], free, touch, most)
                if picks:
                    yield own.iloc[picks].assign(nth=np.arange(len(free) - len(picks), len(free), dtype=np.int32))[[*names, "part", "nth"]]

    def decide(batches):
        """Final choices of each round in order; done on a round's last row if all of its partitions were read."""
        now, have, chosen, open_, kept = None, 0, [], True, []
        for batch in batches:
            for k, own in batch.groupby("round", sort=False):
                if k != now:
                    yield from closed(kept, open_, have, chosen)
                    now, have, chosen, open_, kept = k, int(own["have"].iloc[0]), [], True, []
                for i, v in enumerate(own["v"]):
                    if not open_ or have + len(chosen) >= most:
                        break
                    if chosen and (np.stack(chosen) @ v > touch).any():
                        open_ = False
                        break
                    kept.append(own.iloc[[i]].assign(place=np.int32(have + len(chosen))))
                    chosen.append(v)
        yield from closed(kept, open_, have, chosen)

    def closed(kept, open_, have, chosen):
        if kept:
            yield pd.concat(kept).assign(done=open_ or have + len(chosen) >= most)[["place", *names, "done"]]

    def drop(key, rows, new):
        """Rows of a partition and round that may still be taken."""
        if len(new) and bool(new["done"].iloc[0]):
            return rows.iloc[:0]
        if len(rows) and len(new):
            rows = rows[(np.stack(rows["v"]) @ np.stack(new["v"]).T <= touch).all(axis=1)]
            rows = rows[rows[order] > new[order].max()] if len(rows) else rows
        return rows.sort_values(order)

    while True:
        have = taken.groupBy("round").agg(F.count("*").cast("int").alias("have"))
        picks = left.mapInPandas(offer, f"{kinds}, part int, nth int").join(have, "round", "left").fillna(0, ["have"])
        # `most` rows a partition and round at most
        final = stored(picks.repartition("round").sortWithinPartitions("round", "part", "nth").mapInPandas(decide, f"place int, {kinds}, done boolean"))
        taken = taken.union(final.drop("done"))
        if final.filter("not done").limit(1).count() == 0:
            return taken
        meet = left.select("round", "part").distinct().join(final.select("round", "v", order, "done"), "round").select((F.col("round") + 0).alias("r"), (F.col("part") + 0).alias("p"), "v", order, "done")
        left = stored(left.groupBy("round", "part").cogroup(meet.groupBy("r", "p")).applyInPandas(drop, f"{kinds}, part int").repartition(parts, "part").sortWithinPartitions("round", "part", order))


def greedy(vectors, taken: list, touch: float, most: int) -> list[int]:
    """Places of the vectors that can be added to taken, in order, up to `most` together; taken grows by them."""
    if len(taken) >= most:
        return []
    x = np.stack(vectors.to_numpy())
    free = (x @ np.stack(taken).T <= touch).all(axis=1) if taken else np.ones(len(x), dtype=bool)
    picks = []
    while len(taken) < most and free.any():
        i = int(free.argmax())
        picks.append(i)
        taken.append(x[i])
        free &= x @ x[i] <= touch
        free[: i + 1] = False
    return picks


def packed_spheres(spark: SparkSession, dim: int, rounds: int = 10, most: int | None = None, number: int = 1024, steps: int = 150) -> DataFrame:
    """round, sphere_id, v of independent rounds, seeded i * 999 + 1: to the cap, or until EMPTY steps in a row add nothing."""
    cap = most or max(15 * dim, 120)
    start = [list(r.v) for r in start_spheres(spark, dim).orderBy("sphere_id").collect()]  # two
    spheres, idle = {k: list(start) for k in range(rounds)}, dict.fromkeys(range(rounds), 0)
    for step in itertools.count():
        live = {k: v for k, v in spheres.items() if len(v) < cap and idle[k] < EMPTY}
        if not live:
            break
        new = accepted(candidates(spark, live, step, number, steps), "turn").collect()  # AT_ONCE a round at most
        for r in sorted(new, key=lambda r: (r["round"], r.place)):
            spheres[r["round"]].append(list(r.v))
        found = {r["round"] for r in new}
        idle |= {k: 0 if k in found else idle[k] + 1 for k in live}
    rows = [(k, i, v) for k, own in spheres.items() for i, v in enumerate(own)]
    return spark.createDataFrame(rows, "round long, sphere_id long, v array<double>")


def round_sizes(spheres: DataFrame) -> DataFrame:
    """round, n, total: spheres of each round and of all rounds."""
    each = spheres.groupBy("round").agg(F.count("*").alias("n"))
    return each.join(F.broadcast(each.agg(F.sum("n").alias("total"))), how="cross")  # one row


def discover(spark: SparkSession, dim: int, rounds: int = 10, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The alphabet (action, cos), and the snapped seed matrix (i, j, cos) of the basis of greatest volume."""
    spheres = packed_spheres(spark, dim, rounds, most)
    joined = spheres.alias("a").join(spheres.alias("b"), F.expr("a.round = b.round and a.sphere_id < b.sphere_id"))
    pairs = joined.select(F.aggregate(F.zip_with("a.v", "b.v", lambda x, y: x * y), F.lit(0.0), lambda s, y: s + y).alias("cos"))
    counts = pairs.groupBy(G.histogram_key(F.col("cos")).alias("key")).agg(F.count("*").alias("n"))
    alphabet = G.alphabet(counts, spheres.count())
    best = volume_bases(spheres.select("round", F.col("sphere_id").alias("id"), "v"), dim).filter("best").select("round", F.posexplode("ids").alias("i", "sphere_id"))
    basis = spheres.join(best, ["round", "sphere_id"])
    a, b = basis.select("i", F.col("v").alias("x")), basis.select(F.col("i").alias("j"), F.col("v").alias("y"))
    both = a.join(b, F.col("i") < F.col("j"))  # dim vectors
    seed = both.select("i", "j", snapped_entry(F.aggregate(F.zip_with("x", "y", lambda p, q: p * q), F.lit(0.0), lambda s, y: s + y)).alias("cos"))
    return alphabet, seed
