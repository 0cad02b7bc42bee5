"""Joins of many rows to a lookup when one key may hold most of the rows.

AQE splits a skewed partition only where both sides arrive by their own shuffle.
A lookup that was just aggregated or ranked by the same key keeps that
partitioning, so AQE leaves such a join alone.

``probe_join`` gives the lookup a shuffle of its own and leaves the rest to AQE,
which knows the size of every partition once the rows are shuffled: the wide side
is read once, and only partitions that turn out too large are split.
``lookup_join`` counts the keys first and splits the hot ones itself; it reads
the wide side twice and works without AQE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def probe_join(rows: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal key columns, the columns of ``rows`` first; a null key finds nothing.

    The null-safe comparison is what tells the lookup's partitioning by the plain
    key apart from the one the join wants, so Spark shuffles both sides for it
    (or broadcasts a lookup that turns out small) and AQE may split either.  Give
    the lookup one row per key, unless rows are to be multiplied.
    """
    keys = [on] if isinstance(on, str) else list(on)
    marks = [f"_probe_{k}" for k in keys]
    given = lookup.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    named = given.withColumnsRenamed(dict(zip(keys, marks, strict=True)))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, marks, strict=True)])
    first = rows.select(*keys, *[c for c in rows.columns if c not in keys])
    return first.join(named, same, how).drop(*marks)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left", spread: Sequence[str] | None = None
) -> DataFrame:
    """Join on equal key columns; rows of a hot key are dealt to several tasks.

    A key is hot when it holds more than an even task's share of the rows, so
    there are fewer hot keys than shuffle partitions (they are broadcast), and
    their lookup rows are copied at most twice that many times in all.  The
    slice of a row is a hash of its ``spread`` columns (default: all), which
    gives the same slice when a lost task is repeated.
    """
    keys = [on] if isinstance(on, str) else list(on)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg(F.sum("_n").alias("_n")).scalar() / F.lit(float(tasks))
    slices = F.ceil(F.col("_n") / share).cast("int")
    hot = counts.where(F.col("_n") > share).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], slices.alias("_slices"))
    marks = [f"_hot_{k}" for k in keys]

    def with_slices(df: DataFrame) -> DataFrame:
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
        return df.join(F.broadcast(hot), same, "left").drop(*marks)

    hashed: list[str] | list[Column] = list(spread or [f.name for f in rows.schema.fields if not has_map(f.dataType)])
    slot = F.when(F.col("_slices") > 1, F.pmod(F.xxhash64(*hashed), F.col("_slices")).cast("int")).otherwise(F.lit(0))
    dealt = with_slices(rows).withColumn("_slot", slot).drop("_slices")
    every = F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)
    copied = with_slices(lookup).withColumn("_slot", F.explode(every)).drop("_slices")
    return dealt.join(copied, [*keys, "_slot"], how).drop("_slot")
