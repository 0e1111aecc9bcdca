"""Embedding whitening by hierarchical merging of singular value decompositions.

A partition keeps, of the vectors that it has read, their number, their exact integer sums (so the
mean) and all singular values and right singular vectors of the centred ones. Two such states merge
into one by decomposing both, scaled, over each other, with one more row: the difference of the
means times sqrt(n m / (n + m)). No dimension is ever cut, so the last state has the singular
values and vectors of the whole centred table. States are merged in a tree of FAN; one has about
dims * dims numbers, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import stored

SCALE, SHIFT, FAN, BLOCK = 1024, 100_000, 16, 1024
#: Entries of this size or more are out of range, as those that are not finite.
RANGE = 2.0**31
STATE = "node long, n long, sums array<decimal(38,0)>, values array<double>, vectors array<double>"


@dataclass
class State:
    """n vectors: sums (python integers), singular values and right singular vectors (rows) of the centred ones."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> State:
        """A block of integer vectors."""
        n, sums = len(x), np.array(x.sum(axis=0).tolist(), dtype=object)
        _, values, vectors = np.linalg.svd(centred(x, n, sums), full_matrices=False)
        return cls(n, sums, values, vectors)

    def merged(self, other: State) -> State:
        apart = np.array([float(Decimal(d) / (self.n * other.n)) for d in self.sums * other.n - other.sums * self.n])
        correction = np.sqrt(self.n * other.n / (self.n + other.n)) * apart
        rows = np.concatenate([self.values[:, None] * self.vectors, other.values[:, None] * other.vectors, correction[None]])
        _, values, vectors = np.linalg.svd(rows, full_matrices=False)
        return State(self.n + other.n, self.sums + other.sums, values, vectors)

    def row(self, node: int) -> dict:
        return {"node": node, "n": self.n, "sums": [Decimal(s) for s in self.sums], "values": self.values, "vectors": self.vectors.ravel()}

    @classmethod
    def read(cls, r) -> State:
        return cls(r["n"], np.array([int(s) for s in r["sums"]], dtype=object), np.array(r["values"]), np.array(r["vectors"]).reshape(len(r["values"]), -1))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit integers where squares of them cannot overflow in a sum, else as Python's."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if most * most * max(1, x.shape[1]) < 2**63:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64)


def integers(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """id and x (integers) of the usable rows, and their length.

    Left out are null vectors and those with null, not finite or out of range entries. The length is that of
    the longest usable vector; a shorter one lacks entries, which count as null.
    """
    own = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    good = own.filter(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < RANGE)))
    dims = good.agg(F.max(F.size("v")).alias("d")).first().d or 0
    return good.filter(F.size("v") == dims).select("id", F.transform("v", lambda c: F.floor(SCALE * c) + SHIFT).alias("x")), dims


def matrices(batches: Iterator, dims: int) -> Iterator[tuple]:
    """Ids (Arrow) and integer matrices of at most BLOCK rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column(part.schema.get_field_index("id")), part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def decomposed(x: DataFrame, dims: int) -> State | None:
    """The state of all rows of integers(); none without rows."""

    def read(batches):
        state = None
        for _, block in matrices(batches, dims):
            own = State.of(block)
            state = own if state is None else state.merged(own)
        if state is not None:
            from pyspark import TaskContext

            yield batch_of([state.row(TaskContext.get().partitionId())])

    def merge(table: pa.Table) -> pa.Table:
        states = sorted(table.to_pylist(), key=lambda r: r["node"])
        out = State.read(states[0])
        for r in states[1:]:
            out = out.merged(State.read(r))
        return pa.Table.from_batches([batch_of([out.row(states[0]["node"] // FAN)])])

    now = stored(x.select("id", "x").mapInArrow(read, STATE))
    last = now.agg(F.max("node").alias("node")).first().node
    while last:  # a group has FAN states at most
        now, last = now.groupBy(F.floor(F.col("node") / FAN)).applyInArrow(merge, STATE), last // FAN
    found = now.collect()  # one state
    return State.read(found[0].asDict()) if found else None


def batch_of(found: list[dict]) -> pa.RecordBatch:
    return pa.record_batch({
        "node": pa.array([r["node"] for r in found], pa.int64()), "n": pa.array([r["n"] for r in found], pa.int64()), "sums": pa.array([r["sums"] for r in found], pa.list_(pa.decimal128(38, 0))),
        "values": pa.array([r["values"] for r in found], pa.list_(pa.float64())), "vectors": pa.array([r["vectors"] for r in found], pa.list_(pa.float64())),
    })


@dataclass
class Whitening:
    """A fit: n, sums, the components (unit rows by falling eigenvalue), their eigenvalues and the trace of the covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @classmethod
    def of(cls, state: State, most: int) -> Whitening:
        """Of the state's components the first `most`, as far as their eigenvalues are not zero but for rounding."""
        e = state.values**2 / state.n
        good = state.values > state.values.max(initial=0.0) * np.finfo(float).eps * max(state.n**0.5, len(e))
        v = state.vectors[good][:most]
        v = v * np.where(np.take_along_axis(v, np.abs(v).argmax(axis=1)[:, None], axis=1) < 0, -1.0, 1.0) if len(v) else v
        return cls(state.n, state.sums, v, e[good][:most], float(e.sum()))

    def apply(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.components.T / np.sqrt(self.eigenvalues)


def identity_error(x: DataFrame, dims: int, fit: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity. Tasks send sums of components * components numbers."""
    k, shared = len(fit.components), x.sparkSession.sparkContext.broadcast(fit)

    def run(batches):
        total = np.zeros(k + k * k)
        for _, block in matrices(batches, dims):
            w = shared.value.apply(block)
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.record_batch({"at": pa.array(np.arange(len(total)), pa.int64()), "x": pa.array(total)})

    sums = x.mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()  # k + k * k rows
    total = np.array([r.x for r in sums]) / fit.n
    return float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())


def whitened(vectors: DataFrame, most: int = 8, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, component, n, deviation (decimal), whitened, explained, identity_error: a row for each usable vector and component.

    An entry c becomes floor(SCALE * c) + SHIFT; usable rows are as in integers(). Components whose
    eigenvalue is zero are left out, so equal vectors, one vector or none give no rows. Null ids stay;
    repeated rows count each. Of equal eigenvalues any unit vectors may stand, the same for all rows.
    """
    schema = f"`{id}` long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    x, dims = integers(vectors, id, vector)
    state = decomposed(x, dims) if dims else None
    fit = Whitening.of(state, most) if state is not None else None
    if fit is None or not len(fit.components):
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(x, dims, fit), len(fit.components)
    shared = vectors.sparkSession.sparkContext.broadcast(fit)

    def run(batches):
        fit = shared.value
        for ids, block in matrices(batches, dims):
            away = deviations(block, fit.n, fit.sums)
            far = (away**2).sum(axis=1)
            far = pa.array(far, pa.int64()).cast(pa.decimal128(38, 0)) if far.dtype == np.int64 else pa.array([Decimal(f) for f in far.tolist()], pa.decimal128(38, 0))
            rows = pa.array(np.repeat(np.arange(len(block)), k))
            yield pa.record_batch({
                id: ids.take(rows), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(block))), "n": pa.array(np.full(len(rows), fit.n)), "deviation": far.take(rows),
                "whitened": pa.array(fit.apply(block).ravel()), "explained": pa.array(np.tile(fit.eigenvalues / fit.trace, len(block))), "identity_error": pa.array(np.full(len(rows), error)),
            })

    return x.mapInArrow(run, schema)
