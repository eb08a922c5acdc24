"""Vector expressions over array columns; arithmetic is in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """NULL where a vector has no length: a comparison with a threshold is then not true."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(a: Column) -> Column:
    """The vector over its length, NULL without one; dot products of units are cosines."""
    n = F.nullif(norm(a), F.lit(0.0))
    return F.when(n.isNotNull(), F.transform(a, lambda x: x.cast("double") / n))


def checked(a: Column, dim: int) -> Column:
    """The vector; a wrong length ends the query."""
    return F.when(F.size(a) == dim, a).otherwise(F.raise_error(F.concat(F.lit(f"vector of length {dim} expected, got "), F.size(a).cast("string"))))


def ivf_lists(n: Column) -> Column:
    return F.greatest(F.lit(100), F.floor(F.sqrt(n))).cast("long")
