"""Event-time marks of a stream, kept beside its output.

Spark's own watermark drops late rows without a trace and cannot be read by
another job.  Here the mark is a table with one row per micro-batch, written
after the batch's output in the same ``foreachBatch``.  A batch works with the
mark of the batches before it, and both its output and its mark overwrite the
folder of its number.  So a batch that is repeated after a crash, wherever that
happened, sees the same mark, writes the same rows, and neither skips nor repeats
any.  Readers take the batches that have a mark: those that are complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "watermark timestamp_ntz, rows long, late_rows long"
FIRST = -1  # the number under which the mark of an empty stream is kept


def write_batch(rows: DataFrame, path: str, number: int) -> None:
    """The folder of a micro-batch, replaced if the batch is repeated."""
    out = rows.withColumn("batch", F.lit(number).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def begin(spark: SparkSession, path: str, start: Column) -> None:
    """Set the mark of a stream that has none yet; one that has goes on."""
    none = F.lit(0).cast("long")
    row = spark.range(1).select(start.cast("timestamp_ntz").alias("watermark"), none.alias("rows"), none.alias("late_rows"), F.lit(FIRST).cast("long").alias("batch"))
    row.write.mode("ignore").partitionBy("batch").parquet(path)


def marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{MARK}, batch long").parquet(path)


def mark_before(spark: SparkSession, path: str, number: int) -> Column:
    """The highest mark of the batches before ``number``."""
    return marks(spark, path).where(F.col("batch") < number).agg(F.max("watermark").alias("m")).scalar()


def save_mark(taken: DataFrame, late: DataFrame, ts: str, path: str, number: int) -> None:
    """Mark a batch as complete: its newest row, or the mark it started from."""
    spark = taken.sparkSession
    before = mark_before(spark, path, number)
    top = taken.agg(F.greatest(before, F.max(F.col(ts).cast("timestamp_ntz"))).alias("watermark"), F.count(F.lit(1)).alias("rows"))
    late_rows = late.agg(F.count(F.lit(1)).alias("n")).scalar()
    write_batch(top.withColumn("late_rows", late_rows).coalesce(1), path, number)


def complete(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Rows of batches that have a mark; there is one mark per batch."""
    done = marks(spark, path).where(F.col("batch") > FIRST).select("batch")
    return rows.join(done, "batch", "left_semi")
