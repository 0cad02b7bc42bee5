"""Calendars and gap detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def days_back(spark: SparkSession, as_of: str, days: int) -> DataFrame:
    """One row per day from ``days`` before ``as_of`` to ``as_of``, as text."""
    end = F.lit(as_of).cast("date")
    span = F.sequence(F.date_sub(end, days), end)
    return spark.range(1).select(F.explode(span).alias("day")).select(F.col("day").cast("string").alias("dt"))


def missing_partitions(partitions: DataFrame, tables: Sequence[str], as_of: str, days: int = 30) -> DataFrame:
    """Expected (day, table) pairs without a partition.

    The expected side has ``tables`` × ``days`` rows, so it is the one to
    broadcast; the data side is reduced to its distinct pairs within range.
    """
    spark = partitions.sparkSession
    names = F.explode(F.array(*[F.lit(t) for t in tables]))
    expected = days_back(spark, as_of, days).select("dt", names.alias("missing_table"))
    start = F.date_sub(F.lit(as_of).cast("date"), days).cast("string")
    existing = (
        partitions.where(F.col("dt").between(start, F.lit(as_of)))
        .select("dt", F.col("table_name").alias("missing_table"))
        .distinct()
    )
    return expected.join(existing, ["dt", "missing_table"], "left_anti")
