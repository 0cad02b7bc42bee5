"""File writers and staged promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", rebalance: bool = False) -> None:
    """Snappy Parquet partitioned by ``by``.

    By default every task writes the folders of its own rows, without a shuffle.
    ``rebalance`` first gathers the rows of a folder into few files; AQE then
    splits a folder that holds most of the data over several tasks.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(b) for b in by])
    (
        df.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_by_day(df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = False) -> None:
    write_partitioned(df, path, ["dt"], mode, rebalance)


def write_json(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "append") -> None:
    """JSON-Lines, optionally below ``key=value`` folders."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; blanks around values are kept."""
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_document(df: DataFrame, path: str) -> None:
    """A frame of a few rows as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def stage_and_promote(df: DataFrame, staging: str, target: str, by: Sequence[str], min_rows: int = 1) -> int:
    """Write to staging, check what was written, replace the partitions, drop the stage.

    The target is only touched once the staged files are complete and hold at
    least ``min_rows`` rows; partitions without new rows stay as they are.  A
    stage that is refused, or whose promotion fails, stays for a look at it.
    """
    spark = df.sparkSession
    write_partitioned(df, staging, by)
    staged = spark.read.schema(df.schema).parquet(staging)
    rows = staged.count()
    if rows < min_rows:
        raise ValueError(f"staged {rows} rows, expected at least {min_rows}")
    write_partitioned(staged, target, by)
    remove_path(spark, staging)
    return rows
