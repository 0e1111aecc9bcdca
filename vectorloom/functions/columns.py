"""Column expressions: vectors, policies, rewards, schedules, snapping."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROOTS = (-math.sqrt(0.5), math.sqrt(0.5), -math.sqrt(3) / 2, math.sqrt(3) / 2)
#: The four-digit forms that the roots are matched against.
ROOT_FORMS = (-0.7071, 0.7071, -0.8660, 0.8660)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, y: s + y)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def rounded(x: Column, places: int) -> Column:
    """x rounded as SQL does it: what is rounded to zero keeps its sign, which round() drops."""
    r = F.round(x, places)
    return F.when(r == 0, x * 0.0).otherwise(r)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalised(v: Column, guard: float = 0.0) -> Column:
    """v at length 1; the zero vector is null unless a guard is added to the length."""
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), norm(v) + F.lit(guard)))


def softmax(x: Column) -> Column:
    shifted = F.transform(x, lambda y: F.exp(y - F.array_max(x)))
    return F.transform(shifted, lambda y: y / total(shifted))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def one_hot(action: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == action, 1.0).otherwise(0.0))


def padding_mask(m: Column, bound: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bound - 1)), lambda i: i >= m)


def tokens(gram_row: Column, other_row: Column) -> Column:
    """A board row as one token: both channels, interleaved by column."""
    return F.flatten(F.zip_with(gram_row, other_row, lambda x, y: F.array(x, y)))


def histogram_key(c: Column) -> Column:
    """Thousandths, half to even, as an integer."""
    return F.rint(c * 1000).cast("long")


def histogram_key_single(c: Column) -> Column:
    """The same in single precision throughout."""
    return F.rint(c.cast("float") * F.lit(1000.0).cast("float")).cast("long")


def snapped(v: Column, tolerance: float = 0.03) -> Column:
    """A cosine as one of the alphabet's exact values; the first rule that holds decides, null if none does."""
    out = F.when(v > 0.5 + tolerance, F.lit(None).cast("double"))
    for value in (0.5, -0.5, 0.0, -1.0):
        out = out.when(F.abs(v - F.lit(value)) < tolerance, F.lit(value))
    for exact, form in zip(ROOTS, ROOT_FORMS, strict=True):
        if exact <= 0.5:
            out = out.when(F.abs(v - F.lit(form)) < tolerance, F.lit(exact))
    near = [(F.rint(v * d) / d, F.abs(v - F.rint(v * d) / d)) for d in (2, 3, 4)]
    fits = [F.when((n >= -1 - 1e-9) & (n <= 0.5 + 1e-9) & (away < tolerance), away) for n, away in near]
    least = F.least(*fits)
    for (n, _), own in zip(near, fits, strict=True):
        out = out.when(own == least, n)
    return out.otherwise(F.lit(None).cast("double"))


def snapped_entry(v: Column) -> Column:
    """An off-diagonal entry of a Gram matrix: snapped, else drawn to 0, 0.5 or -0.5 from within 0.1, else as it is."""
    out = F.when(snapped(v).isNotNull(), snapped(v))
    for value in (0.0, 0.5, -0.5):
        out = out.when(F.abs(v - F.lit(value)) < 0.1, F.lit(value))
    return out.otherwise(v)


def snapped_thousandths(key: np.ndarray, tolerance: float = 0.03) -> np.ndarray:
    """snapped_entry() of whole millionths, in thousandths (halves away from zero): the same rules in the same order, on arrays."""
    v = key / 1_000_000
    rules = [(v > 0.5 + tolerance, np.nan)]
    rules += [(np.abs(v - x) < tolerance, x) for x in (0.5, -0.5, 0.0, -1.0)]
    rules += [(np.abs(v - form) < tolerance, exact) for exact, form in zip(ROOTS, ROOT_FORMS, strict=True) if exact <= 0.5]
    near = [np.rint(v * d) / d for d in (2, 3, 4)]
    fits = [np.where((n >= -1 - 1e-9) & (n <= 0.5 + 1e-9) & (np.abs(v - n) < tolerance), np.abs(v - n), np.inf) for n in near]
    least = np.minimum.reduce(fits)
    rules += [((own == least) & np.isfinite(own), n) for n, own in zip(near, fits, strict=True)]
    exact = np.select([r for r, _ in rules], [x for _, x in rules], np.nan)
    drawn = np.select([np.abs(v - x) < 0.1 for x in (0.0, 0.5, -0.5)], [0.0, 0.5, -0.5], np.nan)
    out = np.where(np.isnan(exact), drawn, exact)
    own = np.sign(key) * ((np.abs(key) + 500) // 1000)
    return np.where(np.isnan(out), own, np.rint(np.nan_to_num(out) * 1000)).astype(np.int64)


def reward(r: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (r - low) / (high - low + 1e-5) - 1))


def upper_confidence(q: Column, n: Column, prior: Column, visits: Column, c: float = 2.0) -> Column:
    return F.coalesce(q, F.lit(0.0)) + c * prior * F.sqrt(visits + 1e-8) / (1 + F.coalesce(n, F.lit(0)))


def warm_up_rate(step: Column, steps: int) -> Column:
    w = int(0.1 * steps) + 1
    return F.when(step >= w, 1 - (step - w) / (steps - w + 1e-8)).otherwise(step / w)


def cosine_rate(step: Column, steps: int) -> Column:
    return 0.5 * (1 + F.cos(F.lit(math.pi) * step / steps))


def masked_prior(prior: Column, valid: Column) -> Column:
    """prior over the valid actions, summing to 1; uniform over them where it has no mass there."""
    kept = F.zip_with(prior, valid, lambda p, v: F.when(v, p).otherwise(0.0))
    flat = F.transform(valid, lambda v: v.cast("double"))
    some = F.when(total(kept) > 0, kept).otherwise(flat)
    return F.transform(some, lambda p: F.try_divide(p, total(some)))


def state_key(actions: Column) -> Column:
    """The actions that lead to a state identify it."""
    return F.sha2(F.concat_ws(",", F.transform(actions, lambda a: a.cast("string"))), 256)


def placement(rank: Column, devices: int) -> Column:
    return F.pmod(rank, F.lit(devices))


def batch_size(episodes: int, workers: int) -> int:
    return max(1, episodes // workers)


def batch_sizes(episodes: Column, workers: int) -> Column:
    return F.greatest(F.lit(1), F.floor(episodes / workers))
