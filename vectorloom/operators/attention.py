"""Policies and values of boards by an attention encoder, on batches of states.

A board has a token for each of `bound` places: its Gram row and the row of the partial cosines and counts,
interleaved. Tokens of places without a sphere are masked. Two tokens of the model's own go first; after the
layers (attention of several heads and a two-layer perceptron, each with a residual and a layer norm) the
first gives the policy and the second the value.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Shape:
    bound: int
    actions: int
    width: int = 256
    heads: int = 4
    layers: int = 3


def fixed_weights(shape: Shape) -> Weights:
    """Weights by a rule that other engines can follow: matrix n has sin(1 + 7 i + 13 j + 17 n) / sqrt(rows) at i, j."""
    number = itertools.count()

    def matrix(rows: int, columns: int) -> np.ndarray:
        i, j = np.ogrid[:rows, :columns]
        return np.sin(1 + 7 * i + 13 * j + 17 * next(number)) / rows**0.5

    w = shape.width
    out = {"embed": matrix(2 * shape.bound, w), "embed_bias": matrix(1, w), "own": matrix(2, w)}
    for k in range(shape.layers):
        out |= {f"{k}.{name}": matrix(w, w) for name in ("query", "key", "value", "out")}
        out |= {f"{k}.up": matrix(w, 4 * w), f"{k}.up_bias": matrix(1, 4 * w), f"{k}.down": matrix(4 * w, w), f"{k}.down_bias": matrix(1, w)}
    return out | {"policy": matrix(w, shape.actions), "worth": matrix(w, 1)}


def boards(m: list[int], gram: list, partial: list, dead: list[bool], bound: int) -> np.ndarray:
    """The tokens of boards of at most `bound` spheres: (boards, bound, 2 * bound)."""
    out, size = np.zeros((len(m), bound, bound, 2)), np.asarray(m, dtype=np.int64)
    if not len(size):
        return out.reshape(0, bound, 2 * bound)
    board, at = _places(size**2)
    out[board, at // size[board], at % size[board], 0] = np.concatenate([np.ravel(g) for g in gram])
    known = np.array([len(p) for p in partial])
    board, at = _places(known)
    out[board, 0, at, 1] = np.concatenate([np.asarray(p, dtype=np.float64) for p in partial])
    out[:, 1, 0, 1], out[:, 1, 1, 1], out[:, 2, 0, 1] = size, dead, known
    return out.reshape(len(size), bound, 2 * bound)


def _places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists of such lengths, one after the other: the list of each entry, and its place there."""
    ends = np.cumsum(lengths)
    return np.repeat(np.arange(len(lengths)), lengths), np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)


def times(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """x @ a as one product of two matrices; numpy makes one a board of it."""
    return (x.reshape(-1, x.shape[-1]) @ a).reshape(*x.shape[:-1], a.shape[1])


def embedded(weights: Weights, tokens: np.ndarray) -> np.ndarray:
    return times(tokens, weights["embed"]) + weights["embed_bias"]


def normed(x: np.ndarray) -> np.ndarray:
    centred = x - x.mean(axis=-1, keepdims=True)
    return centred / np.sqrt((centred**2).mean(axis=-1, keepdims=True) + 1e-5)


def attended(weights: Weights, k: int, h: np.ndarray, masked: np.ndarray, heads: int) -> np.ndarray:
    """Attention of layer k over (boards, places, width); masked places are not looked at."""
    n, places, w = h.shape
    split = lambda x: x.reshape(n, places, heads, w // heads).transpose(0, 2, 1, 3)
    q, key, value = (split(times(h, weights[f"{k}.{name}"])) for name in ("query", "key", "value"))
    score = np.where(masked[:, None, None, :], -np.inf, np.einsum("nhpd,nhqd->nhpq", q, key) / (w // heads) ** 0.5)
    score = np.exp(score - score.max(axis=-1, keepdims=True))
    mixed = np.einsum("nhpq,nhqd->nphd", score / score.sum(axis=-1, keepdims=True), value)
    return times(mixed.reshape(n, places, w), weights[f"{k}.out"])


def evaluate(weights: Weights, shape: Shape, tokens: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Policies (boards, actions) and values (0 or more) of boards."""
    n = len(tokens)
    h = np.concatenate([np.broadcast_to(weights["own"], (n, 2, shape.width)), embedded(weights, tokens)], axis=1)
    masked = np.concatenate([np.zeros((n, 2), bool), np.arange(tokens.shape[1])[None] >= np.asarray(m)[:, None]], axis=1)
    for k in range(shape.layers):
        h = normed(h + attended(weights, k, h, masked, shape.heads))
        h = normed(h + times(np.maximum(times(h, weights[f"{k}.up"]) + weights[f"{k}.up_bias"], 0), weights[f"{k}.down"]) + weights[f"{k}.down_bias"])
    logits = h[:, 0] @ weights["policy"]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), np.maximum(h[:, 1] @ weights["worth"], 0)[:, 0]


#: What evaluated() can give, and its types.
GIVEN = {"pi": "array<double>", "value": "double", "first": "array<double>"}


def evaluated(states: DataFrame, shape: Shape, weights: Weights, *keys: str, rows: int = 1024, give: tuple[str, ...] = tuple(GIVEN)) -> DataFrame:
    """keys, pi, value and first (the embedding of the first token), as far as asked for, of states (is_dead, m, gram, partial) of at most shape.bound spheres.

    Weights are broadcast: their number is the shape's. Batches go in slices, which bounds a task's memory. States of one size are
    evaluated together and without the places that they do not fill; where only `first` is asked for, no layer is run.
    """
    shared = states.sparkSession.sparkContext.broadcast(weights)
    kinds = dict(states.dtypes)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), rows):
                b = batch.iloc[at : at + rows]
                m = b["m"].to_numpy()
                tokens = boards(m, b["gram"].tolist(), b["partial"].tolist(), b["is_dead"].to_numpy(), shape.bound)
                out = {}
                if "first" in give:
                    out["first"] = list(embedded(shared.value, tokens[:, 0]))
                if "pi" in give or "value" in give:
                    pi, value = np.empty((len(b), shape.actions)), np.empty(len(b))
                    for k in np.unique(m):
                        own = m == k
                        pi[own], value[own] = evaluate(shared.value, shape, tokens[own, :k], m[own])
                    out |= {"pi": list(pi), "value": value}
                yield b[list(keys)].assign(**{k: out[k] for k in give})

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), *(f"{k} {GIVEN[k]}" for k in give)])
    return states.select(*keys, "is_dead", "m", "gram", "partial").mapInPandas(run, schema)
