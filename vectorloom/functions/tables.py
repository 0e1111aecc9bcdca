"""Table functions for SQL: registered on a session, called laterally."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, DataType, IntegralType, NumericType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from vectorloom.functions.linear import SINGULAR
from vectorloom.operators.geometry import JITTER, LISTED, UNIT

RESULT = StructType().add("action", "integer").add("cos", "double").add("valid", "boolean")


def legality(gram: np.ndarray, partial: list[float], cosines: np.ndarray, dim: int, bound: int) -> np.ndarray:
    """Whether each action is legal; the state's matrix is solved once, for all actions as right-hand sides."""
    m = len(gram)
    if m >= bound:
        return np.zeros(len(cosines), dtype=bool)
    if len(partial) + 1 < min(m, dim):
        return np.ones(len(cosines), dtype=bool)
    rows = np.column_stack([np.tile(np.asarray(partial, dtype=float), (len(cosines), 1)), cosines]).T
    try:
        if m < dim:
            # definite if the spheres' part is, and what the new row leaves of its corner is positive
            half = np.linalg.solve(np.linalg.cholesky(gram + JITTER * np.eye(m)), rows)
            return 1 + JITTER - (half * half).sum(axis=0) > 0
        basis = gram[:dim, :dim]
        if np.linalg.svd(basis, compute_uv=False)[-1] <= SINGULAR:
            return np.zeros(len(cosines), dtype=bool)
        x = np.linalg.solve(basis, rows)
    except np.linalg.LinAlgError:
        return np.zeros(len(cosines), dtype=bool)
    listed = np.abs((gram[:, :dim] @ x)[:, :, None] - cosines).min(axis=2) <= LISTED
    return (np.abs((x * rows).sum(axis=0) - 1) <= UNIT) & listed.all(axis=0)


class LegalActions:
    """legal_actions(m, gram, partial, cosines, dim): a row (action, cos, valid) for each action of a state.

    gram is flat and as long as m * m; cosines and dim are constants. A state with a null, or whose lengths do not
    fit each other, has no actions. The rule is that of geometry.legal_actions.
    """

    #: Spheres at which a state is full.
    BOUND = 75

    @staticmethod
    def analyze(m: AnalyzeArgument, gram: AnalyzeArgument, partial: AnalyzeArgument, cosines: AnalyzeArgument, dim: AnalyzeArgument) -> AnalyzeResult:
        def numbers(kind: DataType) -> bool:
            return isinstance(kind, ArrayType) and isinstance(kind.elementType, NumericType)

        if not isinstance(m.dataType, IntegralType) or not all(numbers(a.dataType) for a in (gram, partial, cosines)):
            raise ValueError("legal_actions takes a whole number and three arrays of numbers")
        if not cosines.isConstantExpression or not dim.isConstantExpression:
            raise ValueError("cosines and dim of legal_actions must be constants")
        if dim.value is None or dim.value < 1 or not cosines.value or any(c is None for c in cosines.value):
            raise ValueError("legal_actions needs a dimension of 1 or more and an alphabet without nulls")
        return AnalyzeResult(RESULT)

    def eval(self, m, gram, partial, cosines, dim) -> Iterator[tuple]:
        if m is None or gram is None or partial is None or m < 1:
            return
        own, row = np.array(gram, dtype=float), np.array(partial, dtype=float)
        if len(own) != m * m or len(row) + 1 > min(m, dim) or np.isnan(own).any() or np.isnan(row).any():
            return
        alphabet = np.array([float(c) for c in cosines])
        yield from ((a, float(c), bool(ok)) for a, (c, ok) in enumerate(zip(alphabet, legality(own.reshape(m, m), list(row), alphabet, dim, self.BOUND), strict=True)))


def register(spark: SparkSession) -> None:
    """Makes the table functions known to a session's SQL."""
    spark.udtf.register("legal_actions", udtf(LegalActions, useArrow=True))
