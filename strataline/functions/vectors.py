"""Vectors as arrays; computed in double whatever they are stored as."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.schema import EPS


def _c(v: str | Column) -> Column:
    return F.col(v) if isinstance(v, str) else v


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: str | Column) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalised(v: str | Column, eps: float = EPS) -> Column:
    """v / (|v| + eps); with eps 0 a zero vector stays zero."""
    size = norm(v) + eps
    if eps == 0:
        size = F.when(size == 0, F.lit(1.0)).otherwise(size)
    # The length is bound once, outside the loop over the elements.
    return F.flatten(F.transform(F.array(size), lambda n: F.transform(_c(v), lambda x: x.cast("double") / n)))


def added(a: str | Column, b: str | Column) -> Column:
    """Element-wise sum, as for features of an image and of its mirror."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") + y.cast("double"))


def cosine_distance(a: str | Column, b: str | Column) -> Column:
    """1 minus the dot product of unit vectors."""
    return F.lit(1.0) - dot(a, b)


def is_pruned(score: Column, threshold: float) -> Column:
    """Scored below the threshold; unscored crops and thresholds of 0 or less prune nothing."""
    return F.lit(threshold > 0) & F.coalesce((score < threshold) & ~F.isnan(score), F.lit(False))
