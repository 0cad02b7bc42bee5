"""Aggregation helpers that stay bounded on hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def array_elements(df: DataFrame, key: str, arrays: Sequence[str]) -> DataFrame:
    """``key``, ``col`` and ``val`` of every element that is not null, with one row per occurrence."""

    def tag(name: str) -> Column:
        values = F.coalesce(F.col(name), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("col"), v.alias("val")))

    tagged = F.flatten(F.array(*[tag(a) for a in arrays]))
    return df.select(key, F.explode(tagged).alias("_e")).select(key, "_e.col", "_e.val").where(F.col("val").isNotNull())


def element_counts(df: DataFrame, key: str, arrays: Sequence[str]) -> DataFrame:
    """The union of array columns as a table: ``key``, ``column``, ``element`` and how often it occurs.

    One row per element, counted in the map tasks first, so a key with any number
    of elements is never one row; it is the form to join and to filter by.
    """
    counted = array_elements(df, key, arrays).groupBy(key, "col", "val").agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.select(key, F.col("col").alias("column"), F.col("val").alias("element"), "occurrences")


def array_unions(df: DataFrame, key: str, arrays: Sequence[str]) -> DataFrame:
    """Sorted distinct elements per key for several array columns at once.

    Elements are de-duplicated under (key, column, element) before they meet,
    so the rows of a hot key spread over all tasks and the last step only
    holds what the result row must hold; ``element_counts`` has no such row.
    """
    elements = array_elements(df, key, arrays).distinct()
    return elements.groupBy(key).agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("col") == a, F.col("val")))).alias(a)
            for a in arrays
        ]
    )


def global_or_zero(c: Column, name: str) -> Column:
    """Mean that is 0 for no rows."""
    return F.coalesce(F.avg(c), F.lit(0.0)).alias(name)
