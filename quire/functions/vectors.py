"""Dense-vector Column expressions (VEC-2, FN-18).

Vectors are ``array<float|double>`` columns; arithmetic is done in double
with higher-order functions, so it stays JVM-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, z: acc + z)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """VEC-2: cosine similarity; 0 when either vector is zero, null when either
    is null."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)),
                      F.when(_c(a).isNotNull() & _c(b).isNotNull(), F.lit(0.0)))


def unit(v, v_norm) -> Column:
    """``v / |v|`` given its norm column; a zero vector stays zero."""
    return F.when(_c(v_norm) > 0, F.transform(_c(v), lambda x: x.cast("double") / _c(v_norm))).otherwise(
        F.transform(_c(v), lambda x: F.lit(0.0)))


def normalized(v) -> Column:
    """``unit(v, norm(v))`` with the norm evaluated once, not for each element."""
    return F.transform(F.array(norm(v)), lambda n: unit(v, n))[0]


def dot_literal(v, values: Sequence[float]) -> Column:
    """Dot product with a constant vector: one literal array and a left fold
    (a small plan; unrolling d terms makes a deep tree that is slow to
    optimise and compile)."""
    const = F.lit([float(x) for x in values]).cast("array<double>")
    prods = F.zip_with(_c(v), const, lambda x, y: x.cast("double") * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, z: acc + z)
