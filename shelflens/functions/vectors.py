"""Expressions over vectors held as ``array<float>`` or ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflens.config import MIN_NORM


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
        )
    )


def reject_reason(vector: Column, vector_norm: Column) -> Column:
    """Why a vector cannot be scored; NULL for a usable one."""
    return (
        F.when(vector.isNull() | (F.size(vector) == 0), F.lit("empty"))
        .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x)), F.lit("not a number"))
        .when(F.isnan(vector_norm) | (vector_norm == float("inf")), F.lit("not a number"))
        .when(vector_norm <= MIN_NORM, F.lit("zero norm"))
    )


def is_valid(vector: Column) -> Column:
    """True exactly where ``reject_reason`` is NULL."""
    n = norm(vector)
    return F.coalesce(
        (F.size(vector) > 0)
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))
        & (n > MIN_NORM)
        & (n < float("inf")),
        F.lit(False),
    )
