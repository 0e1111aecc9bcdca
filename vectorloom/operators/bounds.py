"""Products of blocks of vectors that skip the pairs of blocks whose vectors are too far apart.

Angles obey the triangle inequality, so two vectors are no nearer than the difference of their angles to any
third one. PIVOTS vectors of the table are such third ones. Vectors are dealt to at most PARTS of gram (more only
for a table of over PARTS * LARGEST rows) ranges of (nearest pivot, angle to it), and these are cut to blocks of BLOCK rows. A vector is sent to ranges, not to blocks, so the
shuffle grows with the table. A block keeps the least and greatest angle of its vectors to each
pivot, and of their lengths. From these follows the greatest product that a pair of blocks can hold. A pair
that cannot reach what is asked for is not multiplied, and a block without others to meet in a range is not sent there. How many can be skipped depends on the
vectors: many where they lie in clusters, few where they point everywhere in many dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.operators import gram
from vectorloom.sources.tables import stored

PIVOTS = 16
#: What rounding may take from an angle or a product.
SLACK = 1e-6


def pivots(vectors: DataFrame, number: int = PIVOTS) -> np.ndarray:
    """`number` vectors of length 1, those of least hash of their ids."""
    found = vectors.orderBy(F.xxhash64("id"), "id").limit(number).collect()
    v = np.array([r.v for r in found])
    norm = np.linalg.norm(v, axis=1, keepdims=True) if len(found) else v
    return (v / np.where(norm > 0, norm, 1.0)) if len(found) else v


def blocks(vectors: DataFrame, points: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """id, v, block of vectors (id, v) near each other, and of each block low and high: angles to the pivots, then the length."""
    shared = vectors.sparkSession.sparkContext.broadcast(points)  # PIVOTS vectors
    parts, size = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), gram.BLOCK
    parts = max(min(parts, gram.PARTS), -(-vectors.count() // gram.LARGEST))

    def angles(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norm = np.linalg.norm(v, axis=1)
        return np.arccos(np.clip(v @ shared.value.T / np.where(norm > 0, norm, 1.0)[:, None], -1, 1)), norm

    def locate(batches):
        for batch in batches:
            if batch.num_rows:
                far, _ = angles(gram.matrix_of(batch.column("v")))
                cell = far.argmin(axis=1)
                yield pa.record_batch({"id": batch.column("id"), "v": batch.column("v"), "cell": pa.array(cell, pa.int32()), "away": pa.array(far[np.arange(len(cell)), cell])})

    def number(batches):
        from pyspark import TaskContext

        at, first = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            yield pa.record_batch({"id": batch.column("id"), "v": batch.column("v"), "block": pa.array(first + (at + np.arange(batch.num_rows)) // size, pa.int64())})
            at += batch.num_rows

    def edges(key: tuple, table: pa.Table) -> pa.Table:
        far, norm = angles(gram.matrix_of(table.column("v")))
        low, high = np.where(norm[:, None] > 0, far, 0.0).min(axis=0), np.where(norm[:, None] > 0, far, np.pi).max(axis=0)
        return pa.table({"block": [key[0].as_py()], "low": [[*low, norm.min()]], "high": [[*high, norm.max()]]})

    placed = vectors.mapInArrow(locate, "id long, v array<double>, cell int, away double").repartitionByRange(parts, "cell", "away", "id").sortWithinPartitions("cell", "away", "id")
    own = stored(placed.mapInArrow(number, "id long, v array<double>, block long"))
    return own, own.groupBy("block").applyInArrow(edges, "block long, low array<double>, high array<double>")


def reach(a: str, b: str) -> Column:
    """The greatest product that a vector of block a can have with one of block b."""
    n = F.size(f"{a}.low") - 1
    low, high = lambda x: F.slice(f"{x}.low", 1, n), lambda x: F.slice(f"{x}.high", 1, n)
    apart = F.greatest(F.array_max(F.zip_with(low(a), high(b), lambda x, y: x - y)), F.array_max(F.zip_with(low(b), high(a), lambda x, y: x - y)), F.lit(0.0))
    cos = F.cos(F.greatest(apart - SLACK, F.lit(0.0)))
    length = lambda side: F.element_at(f"{a}.{side}", -1) * F.element_at(f"{b}.{side}", -1)
    return F.when(cos >= 0, cos * length("high")).otherwise(cos * length("low")) + SLACK


def products(left: DataFrame, right: DataFrame, pairs: DataFrame, shrink: Callable[[np.ndarray, np.ndarray, Iterator], dict], schema: str) -> DataFrame:
    """shrink(ids of a range of left, of right, tiles) for each pair of ranges that holds pairs (p, q) of blocks.

    tiles are slices of the left and of the right ids, sorted within, and the products of a pair of blocks. A vector is sent once to
    each range that its block has a pair with.
    """

    def run(key: tuple, table: pa.Table, own: pa.Table) -> pa.Table:
        side, block = table.column("side").to_numpy(zero_copy_only=False), table.column("block").to_numpy()
        ids, v = gram.matrix(table)
        ends, found = [], []
        for at in (np.flatnonzero(side), np.flatnonzero(~side)):
            at = at[np.lexsort((ids[at], block[at]))]
            names, start = np.unique(block[at], return_index=True)
            ends.append({n: slice(i, j) for n, i, j in zip(names.tolist(), start.tolist(), [*start[1:].tolist(), len(at)], strict=True)})
            found.append((ids[at], v[at]))
        (i, u), (j, w) = found

        def tiles():
            for x, y in zip(own.column("p").to_pylist(), own.column("q").to_pylist(), strict=True):
                p, q = ends[0][x], ends[1][y]
                yield p, q, u[p] @ w[q].T

        return pa.table(shrink(i, j, tiles()))

    ranges = pairs.select("p", "q", F.shiftright("p", 32).alias("a"), F.shiftright("q", 32).alias("b"))
    ends = ranges.select("a", "b", F.explode(F.array(F.struct(F.col("p").alias("block"), F.lit(True).alias("side")), F.struct(F.col("q").alias("block"), F.lit(False).alias("side")))).alias("x")).select("a", "b", "x.*").distinct()
    both = left.withColumn("side", F.lit(True)).union(right.withColumn("side", F.lit(False)))
    sent = both.join(ends, ["block", "side"]).select("id", "v", "side", "block", F.col("a").alias("from"), F.col("b").alias("to"))
    return sent.groupBy("from", "to").cogroup(ranges.groupBy("a", "b")).applyInArrow(run, schema)


def contacts_within(left: DataFrame, right: DataFrame, least: float, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """id, max_cos of the rows of left whose greatest product with right is `least` or more, and all pairs of blocks (p, q, kept)."""
    a, b = gram.vectors_of(left, id, vector), gram.vectors_of(right, id, vector)
    points = pivots(b)
    if not len(points):
        none = a.sparkSession
        return none.createDataFrame([], "id long, max_cos double"), none.createDataFrame([], "p long, q long, kept boolean")
    (x, x_edges), (y, y_edges) = blocks(a, points), blocks(b, points)
    pairs = x_edges.alias("a").join(y_edges.alias("b"), how="cross").select(F.col("a.block").alias("p"), F.col("b.block").alias("q"), (reach("a", "b") >= least).alias("kept"))  # blocks, not rows

    def shrink(i, j, tiles):
        most = np.full(len(i), -np.inf)
        for p, _, c in tiles:
            most[p] = np.maximum(most[p], c.max(axis=1))
        return {"id": i, "max_cos": most}

    out = products(x, y, pairs.filter("kept"), shrink, "id long, max_cos double").groupBy("id").agg(F.max("max_cos").alias("max_cos"))
    return out.filter(F.col("max_cos") >= least), pairs


def nearest(frame: DataFrame, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """id, neighbour, cos as gram.nearest() has them, and all pairs of different blocks (p, q, kept).

    Each vector's best within its own block comes first. A pair of blocks is kept only if it can hold a product
    as good as the worst of these in one of the two.
    """
    vectors = gram.vectors_of(frame, id, vector)
    points = pivots(vectors)
    if not len(points):
        none = vectors.sparkSession
        return none.createDataFrame([], "id long, neighbour long, cos double"), none.createDataFrame([], "p long, q long, kept boolean")
    own, edges = blocks(vectors, points)

    def best(ids, others, c):
        """The first of each row's greatest products, by the other's id."""
        c, order = np.round(c, 6), np.argsort(others, kind="stable")
        at = order[c[:, order].argmax(axis=1)]
        return {"id": ids, "neighbour": others[at], "cos": c[np.arange(len(ids)), at]}

    def within(key: tuple, table: pa.Table) -> pa.Table:
        ids, v = gram.matrix(table)
        c = v @ v.T
        np.fill_diagonal(c, -np.inf)
        found = best(ids, ids, c)
        alone = np.isneginf(found["cos"])
        return pa.table({"block": np.full(len(ids), key[0].as_py())} | {k: pa.array(x, mask=alone if k != "id" else None) for k, x in found.items()})

    def across(i, j, tiles):
        one, two = gram.Best(i), gram.Best(j)
        for p, q, c in tiles:
            one.see(p, c, j[q])
            two.see(q, c.T, i[p])
        one, two = one.columns(), two.columns()
        return {k: np.concatenate([one[k], two[k]]) for k in one}

    first = stored(own.groupBy("block").applyInArrow(within, "block long, id long, neighbour long, cos double"))
    floors = first.groupBy("block").agg(F.min(F.coalesce("cos", F.lit(float("-inf")))).alias("floor"))
    known = stored(edges.join(floors, "block"))
    reached = reach("a", "b") >= F.least("a.floor", "b.floor")
    pairs = known.alias("a").join(known.alias("b"), F.col("a.block") < F.col("b.block")).select(F.col("a.block").alias("p"), F.col("b.block").alias("q"), reached.alias("kept"))  # blocks, not rows
    found = first.filter("neighbour is not null").select("id", "neighbour", "cos").union(products(own, own, pairs.filter("kept"), across, "id long, neighbour long, cos double"))
    top = found.groupBy("id").agg(F.max(F.struct("cos", (-F.col("neighbour")).alias("other"))).alias("m"))
    return top.select("id", (-F.col("m.other")).alias("neighbour"), "m.cos"), pairs


def skipped(pairs: DataFrame) -> DataFrame:
    """pairs, skipped: how many pairs of blocks there are, and how many of them are not multiplied."""
    return pairs.agg(F.count("*").alias("pairs"), F.count(F.when(~F.col("kept"), 1)).alias("skipped"))
