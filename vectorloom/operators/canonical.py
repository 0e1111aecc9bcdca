"""States that are the same but for the order of their spheres.

A Gram matrix is brought to a canonical order: spheres get colours by the multisets of their cosines, again
and again with the colours of the others, until no class splits further; where classes of several are left, each
member of the first of them is set apart in turn and the least matrix is taken. Equal states reached by
other actions then have equal keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Cosines are compared in steps of this size.
STEP = 1e-4


def refined(codes: np.ndarray, colours: np.ndarray) -> np.ndarray:
    """Colours 0, 1, ... after refinement; they do not depend on the spheres' order."""
    while True:
        marks = [(c, tuple(sorted(zip(row.tolist(), colours.tolist(), strict=True)))) for c, row in zip(colours.tolist(), codes, strict=True)]
        names = {m: i for i, m in enumerate(sorted(set(marks)))}
        after = np.array([names[m] for m in marks])
        if len(names) == len(set(colours.tolist())):
            return after
        colours = after


def orders(codes: np.ndarray, colours: np.ndarray) -> Iterator[np.ndarray]:
    """Orders of the spheres, among them the canonical one."""
    colours = refined(codes, colours)
    sizes = np.bincount(colours)
    if (sizes == 1).all():
        yield np.argsort(colours)
        return
    cell = int(np.flatnonzero(sizes > 1)[0])
    seen = set()
    for i in np.flatnonzero(colours == cell):
        others = np.delete(np.arange(len(codes)), i)
        twin = next((j for j in seen if (np.delete(codes[i], [i, j]) == np.delete(codes[j], [i, j])).all()), None)
        if twin is not None:  # exchanging the two changes nothing
            continue
        seen.add(int(i))
        apart = 2 * colours
        apart[others] += 1
        yield from orders(codes, apart)


def canonical(m: int, gram: np.ndarray, partial: np.ndarray) -> tuple[bytes, list[int]]:
    """The least of the state's forms under orders of its spheres, and that order.

    A cosine of the partial row belongs to the sphere that it was given for and moves with it.
    """
    codes = np.rint(np.asarray(gram, dtype=np.float64).reshape(m, m) / STEP).astype(np.int64)
    given = np.full(m, 1 << 40, dtype=np.int64)
    given[: len(partial)] = np.rint(np.asarray(partial, dtype=np.float64) / STEP)
    start = np.unique(given, return_inverse=True)[1]
    best = min((codes[o][:, o].ravel().tolist() + given[o].tolist(), o.tolist()) for o in orders(codes, start))
    return np.array([m, *best[0]], dtype="<i8").tobytes(), best[1]


@F.pandas_udf(StringType())
def state_key(m: pd.Series, gram: pd.Series, partial: pd.Series) -> pd.Series:
    """A hash of the canonical form."""
    return pd.Series([sha256(canonical(a, b, c)[0]).hexdigest() for a, b, c in zip(m, gram, partial, strict=True)])


def merged(states: DataFrame, *keys: Column) -> DataFrame:
    """key, n and the first (by keys) of the states (m, gram, partial) that are equal but for order."""
    first = F.struct(*keys, "m", "gram", "partial")
    return states.withColumn("key", state_key("m", "gram", "partial")).groupBy("key").agg(F.count("*").alias("n"), F.min(first).alias("first"))
