"""Exact ranks, running totals and top-n without one task per group.

``row_number() <= n`` needs nothing special: Spark trims every map task to n
rows per key before the shuffle (WindowGroupLimit), so a hot key sends at most
n rows per task.  A *full* ranking or running sum has no such bound; for those
``running_totals`` range-partitions on group and order together, which splits a
hot group over many tasks, and adds the totals of the earlier chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .joins import probe_join


def top_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per key; ``order_by`` must be total for a stable result."""
    position = rank or "_position"
    window = Window.partitionBy(*keys).orderBy(*order_by)
    out = df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= n)
    return out if rank else out.drop(position)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Survivor per key."""
    return top_n(df, keys, order_by, 1)


# Rows per chunk: enough to be worth a task, few enough to sort in memory.
SMALL_CHUNK, LARGE_CHUNK = 1_000, 2_000_000


def chunk_count(stored: DataFrame) -> int:
    """Chunks for a frame that is on disk already, so counting it is cheap."""
    rows = stored.count()
    usual = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, ceil(rows / SMALL_CHUNK)), ceil(rows / LARGE_CHUNK))


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    position: str,
    sums: Mapping[str, Column] | None = None,
    partition_by: Sequence[str] = (),
    chunks: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add the 1-based ``position`` and inclusive running ``sums``.

    Keep ``df`` narrow.  It is checkpointed before the range partitioning, whose
    sampling pass would otherwise compute the input twice (``stored=True`` says
    it is on disk already), and after it, so that the chunk number stays the
    same when a lost task is recomputed.  The chunk table has at most ``chunks``
    rows per group.
    """
    sums = dict(sums or {})
    groups = list(partition_by)
    lead = [F.col(g).asc_nulls_first() for g in groups]
    values = {f"_v_{name}": c for name, c in sums.items()}
    source = df.withColumns(values) if stored else cut_lineage(df.withColumns(values))
    n = chunks or chunk_count(source)
    chunked = source.repartitionByRange(n, *lead, *order_by)
    staged = cut_lineage(chunked.withColumn("_chunk", F.spark_partition_id()))
    totals = staged.groupBy("_chunk", *groups).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_t{v}") for v in values]
    )
    before = (
        Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        F.col("_chunk").alias("_oc"),
        *[F.col(g).alias(f"_og_{g}") for g in groups],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o_n"),
        *[F.sum(f"_t{v}").over(before).alias(f"_o{v}") for v in values],
    )
    if not groups:
        offsets = F.broadcast(offsets)  # one row per chunk
    inside = (
        Window.partitionBy("_chunk", *groups)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    on = reduce(
        and_,
        [F.col("_chunk") == F.col("_oc")] + [F.col(g).eqNullSafe(F.col(f"_og_{g}")) for g in groups],
    )
    joined = staged.join(offsets, on, "inner")
    out = joined.withColumn(position, (F.count(F.lit(1)).over(inside) + F.col("_o_n")).cast("long"))
    for name in sums:
        v = f"_v_{name}"
        local = F.coalesce(F.sum(v).over(inside), F.lit(0))
        out = out.withColumn(name, local + F.coalesce(F.col(f"_o{v}"), F.lit(0)))
    return out.select(*df.columns, position, *sums)


def full_rank(
    df: DataFrame, key: str, order_by: Sequence[Column], rank: str, partition_by: Sequence[str] = (), using: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """``key`` and its exact row number inside the group, computed on narrow rows."""
    narrow = df.select(*dict.fromkeys([key, *partition_by, *using]))
    return running_totals(narrow, order_by, rank, partition_by=partition_by, stored=stored).select(key, rank)


def percent_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Share of the other rows that come strictly before; nulls sort first.

    Works on the distinct values with their counts, so equal values need no
    ordering among themselves and a value held by many rows is one row here.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    cumulative = running_totals(
        counts, [F.col(value).asc_nulls_first()], "_p", {"_upto": F.col("_n")}
    )
    total = df.agg(F.count(F.lit(1)).alias("_all")).scalar()
    before = (F.col("_upto") - F.col("_n")).cast("double")
    share = F.when(total > 1, before / (total - 1)).otherwise(F.lit(0.0))
    plain = F.col(value) + 0.0 if df.schema[value].dataType == T.DoubleType() else F.col(value)  # no -0.0
    text = F.coalesce(F.hex(plain.cast("string")), F.lit("null"))
    ranked = cumulative.select(text.alias("_value"), share.alias(out))
    return probe_join(df.withColumn("_value", text), ranked, "_value").drop("_value")


def category_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """0-based position of the value among the sorted distinct values.

    A missing value is the text ``nan``, as after a cast to text.
    """
    keyed = df.withColumn("_value", F.coalesce(F.col(column).cast("string"), F.lit("nan")))
    values = keyed.select("_value").distinct()
    codes = running_totals(values, [F.col("_value").asc()], "_p")
    codes = codes.select("_value", (F.col("_p") - 1).alias(out))
    return probe_join(keyed, codes, "_value").drop("_value")
