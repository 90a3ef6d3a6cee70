"""Vector expressions on ``array<float>`` columns, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalise(v: Column) -> Column:
    """Scale to unit length in double; a zero vector stays zero."""
    # The norm is bound as a lambda argument so that it is worked out once per
    # row instead of once per element.
    scaled = F.transform(
        F.array(norm(v)),
        lambda n: F.transform(
            v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))
        ),
    )
    return scaled[0]
