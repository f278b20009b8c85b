"""Dense vector arithmetic on ``array<double>`` columns (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_doubles(v: Column | str) -> Column:
    return F.transform(_col(v), lambda x: x.cast("double"))


def vsum(v: Column | str) -> Column:
    return F.aggregate(_col(v), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return vsum(F.zip_with(_col(a), _col(b), lambda x, y: x * y))


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def scale(v: Column | str, s: Column | float) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_col(v), lambda x: x * s)


def add(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def subtract(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x - y)


def unit(v: Column | str) -> Column:
    """``v / ||v||``; a zero vector stays zero.

    The norm is bound once per row (a one-element array of a struct), not
    re-evaluated inside the per-element lambda.
    """
    bound = F.array(F.struct(_col(v).alias("v"), norm(v).alias("n")))
    return F.element_at(
        F.transform(
            bound,
            lambda s: F.transform(
                s["v"], lambda x: F.when(s["n"] > 0, x / s["n"]).otherwise(F.lit(0.0))
            ),
        ),
        1,
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    return dot(a, b) / (norm(a) * norm(b))
