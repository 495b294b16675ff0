"""Expressions over ``array<float|double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def literal(vector: Sequence[float]) -> Column:
    """A query vector as an ``array<double>`` literal."""
    return F.array(*[F.lit(float(x)) for x in vector])


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision; on unit vectors this is the cosine."""
    products = F.zip_with(_column(a), _column(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_column(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def _with_value(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a binding, so that lambdas do not repeat it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def l2_normalize(a: Column | str) -> Column:
    """Divide by the length; the zero vector stays zero."""

    def divided(vector: Column) -> Column:
        return _with_value(
            norm(vector),
            lambda length: F.transform(
                vector, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(F.lit(0.0))
            ),
        )

    return _with_value(_column(a), divided)


def hash_buckets(text: Column | str, dim: int) -> Column:
    """The bucket of every word as a string: the first 32 bits of its MD5, modulo ``dim``."""
    words = F.filter(F.split(_column(text), r"\s+"), lambda w: w != "")
    return F.transform(
        words,
        lambda w: (F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long") % dim).cast("string"),
    )
