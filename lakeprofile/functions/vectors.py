"""Vector algebra on array columns, kept on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import col_of


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col_of(a), col_of(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 for missing, empty or zero vectors."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    value = F.try_divide(dot(a, b), norm)
    return F.coalesce(F.when(F.isnan(value), F.lit(0.0)).otherwise(value), F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
