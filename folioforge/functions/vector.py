"""Vectors as arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays zero."""
    return F.element_at(F.transform(F.array(F.greatest(norm(a), F.lit(1e-9))), lambda n: F.transform(a, lambda x: x.cast("double") / n)), 1)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def combine(parts: list[tuple[Column, float]]) -> Column:
    """Unit vectors of the parts, each times its weight, one after another; parts of weight 0 are left out."""

    def scaled(c: Column, w: float) -> Column:
        return F.transform(unit(c), lambda x: x * w)

    used = [scaled(c, w) for c, w in parts if w]
    if not used:
        raise ValueError("no part has a weight")
    return F.concat(*used)


def entropy(counts: list[Column]) -> Column:
    """Entropy in nats of the shares of *counts*; 0 where they sum to 0."""
    total = sum(counts[1:], counts[0]).cast("double")
    terms = [F.when(c > 0, -(c / total) * F.ln(c / total)).otherwise(0.0) for c in counts]
    return F.when(total > 0, sum(terms[1:], terms[0])).otherwise(0.0)
