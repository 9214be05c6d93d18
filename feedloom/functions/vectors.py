"""Vector expressions on array columns.

These stay in the JVM.  Scans that compare every stored vector with a query use
the Arrow form in operators.search instead, which is one matrix product per batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_l2(a: Column, b: Column) -> Column:
    gaps = F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(a), F.lit(0.0), lambda s, x: s + x * x))


def has_direction(a: Column) -> Column:
    """Whether any part differs from zero; a cheap filter that does not repeat the scaling."""
    return F.coalesce(F.exists(a, lambda x: x != 0), F.lit(False))


def unit(a: Column) -> Column:
    """The vector scaled to length one; null for a zero vector.

    The length is bound once as a one-element array: named inside the inner lambda it would
    be computed again for every element.
    """
    lengths = F.filter(F.array(norm(a)), lambda n: n > 0)
    return F.get(F.transform(lengths, lambda n: F.transform(doubles(a), lambda x: x / n)), F.lit(0))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity, in 0..2; null when either vector is zero."""
    return 1.0 - F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_l2(a, b))


def negative_inner_product(a: Column, b: Column) -> Column:
    return -dot(a, b)


def parsed(text: Column) -> Column:
    """A vector stored as text, `[0.1, 0.2]`, as an array of floats."""
    return F.from_json(text, "array<float>")
