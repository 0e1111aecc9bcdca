"""Small dense linear algebra in column expressions: matrices are arrays of rows of doubles.

Elimination is a fold over the columns, so a matrix never leaves the JVM and a plan has no
Python worker. Made for the dimensions of a search (up to some dozens), one matrix a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorloom.functions.columns import dot

#: A pivot of this size or less counts as zero.
SINGULAR = 1e-9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def rows_of(flat: Column, m: Column) -> Column:
    """The rows of a flat m x m matrix."""
    return F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.slice(flat, i * m + 1, m))


def with_diagonal(rows: Column, value: float) -> Column:
    """The matrix with a value added to its diagonal."""
    return F.transform(rows, lambda r, i: F.transform(r, lambda x, j: F.when(i == j, x + value).otherwise(x)))


def bordered(rows: Column, row: Column) -> Column:
    """A matrix with one more row and column, and 1 in the corner."""
    wide = F.zip_with(rows, row, lambda r, x: F.concat(r, F.array(x)))
    return F.concat(wide, F.array(F.concat(row, F.array(F.lit(1.0)))))


def gram_of(vectors: Column) -> Column:
    """All dot products of an array of vectors."""
    return F.transform(vectors, lambda x: F.transform(vectors, lambda y: dot(x, y)))


def eliminated(rows: Column, n: Column, pivoting: bool = True) -> Column:
    """rows and pivots after Gauss-Jordan elimination of the first n columns.

    With pivoting the row of greatest entry is taken for each column (the first of equals), and rows
    become the identity in these columns; pivots are signed by the exchanges of rows, so their product is the
    determinant. A zero pivot makes the entries null, not an error.
    """

    def step(state: Column, k: Column) -> Column:
        heads = F.transform(state["rows"], lambda r, i: F.when(i < k, F.lit(-1.0)).otherwise(F.coalesce(F.abs(F.element_at(r, k + 1)), F.lit(0.0))))
        taken = let(heads, lambda h: (F.array_position(h, F.array_max(h)) - 1).cast("int")) if pivoting else k

        def reduce(p: Column) -> Column:
            own = F.element_at(state["rows"], p + 1)
            pivot = F.element_at(own, k + 1)
            other = F.element_at(state["rows"], k + 1)

            def clear(scaled: Column) -> Column:
                less = lambda r: F.zip_with(r, scaled, lambda x, y: x - F.element_at(r, k + 1) * y)
                return F.transform(state["rows"], lambda r, i: F.when(i == k, scaled).when(i == p, less(other)).otherwise(less(r)))

            rows = let(F.transform(own, lambda x: F.try_divide(x, pivot)), clear)
            return F.struct(rows.alias("rows"), F.concat(state["pivots"], F.array(F.when(p == k, pivot).otherwise(-pivot))).alias("pivots"))

        return let(taken, reduce)

    start = F.struct(rows.alias("rows"), F.expr("cast(array() as array<double>)").alias("pivots"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), start, step)


def regular(done: Column) -> Column:
    """Whether no pivot of an elimination is zero."""
    return F.forall(done["pivots"], lambda p: p.isNotNull() & (F.abs(p) > SINGULAR))


def inverse(rows: Column, n: Column) -> Column:
    """The inverse of an n x n matrix; null if it is singular."""
    wide = F.transform(rows, lambda r, i: F.concat(r, F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.when(i == j, 1.0).otherwise(0.0))))
    return let(eliminated(wide, n), lambda done: F.when(regular(done), F.transform(done["rows"], lambda r: F.slice(r, n + 1, n))))


def definite(rows: Column, n: Column) -> Column:
    """Whether a symmetric matrix is positive definite: all pivots of the elimination in order are positive."""
    return F.forall(eliminated(rows, n, pivoting=False)["pivots"], lambda p: F.coalesce(p > 0, F.lit(False)))


def log_determinant(rows: Column, n: Column) -> Column:
    """The logarithm of a positive determinant; null where it is not positive."""

    def summed(done: Column) -> Column:
        good = F.forall(done["pivots"], lambda p: F.coalesce(p != 0, F.lit(False)))
        negative = F.size(F.filter(done["pivots"], lambda p: p < 0)) % 2 == 1
        return F.when(good & ~negative, F.aggregate(done["pivots"], F.lit(0.0), lambda s, p: s + F.log(F.abs(p))))

    return let(eliminated(rows, n), summed)


def times(rows: Column, x: Column) -> Column:
    """A matrix times a vector."""
    return F.transform(rows, lambda r: dot(r, x))
