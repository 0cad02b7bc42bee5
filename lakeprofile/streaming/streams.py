"""File streams that process what is new and stop (``availableNow``).

Progress lives in the checkpoint folder: a run after a crash repeats the last
micro-batch with the same files, and every sink below is idempotent for that.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import all_present
from ..operators import keyed_table
from ..operators.incremental import API_QUOTAS, delta_read, newest_stored, widths_of
from . import marks


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Feed every pending micro-batch to ``handle`` and wait for the end."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_delta(
    stream: DataFrame, required: Sequence[str], updated_at: str, out: str, checkpoint: str, start: Column, after: Callable[[str, int], None] | None = None
) -> None:
    """Rows newer than the stored watermark, with the required texts.

    Below ``out``: ``rows``, ``late`` (those with the texts that are not newer: they came after the watermark had passed
    them) and ``marks``, the watermark after each micro-batch.  ``start`` is the watermark of the first run; later runs go
    on from the stored one.  Rows without a time are in neither table, as in the batch form.  ``after(step, batch)`` is
    called behind each of the steps ``rows``, ``late`` and ``marks``.
    """
    spark = stream.sparkSession
    paths = {name: f"{out}/{name}" for name in ("rows", "late", "marks")}
    marks.begin(spark, paths["marks"], start)
    tell = after or (lambda step, batch: None)

    def take(batch: DataFrame, number: int) -> None:
        mark = marks.mark_before(spark, paths["marks"], number)
        texts = batch.where(all_present(*required))
        fresh, late = delta_read(texts, mark, updated_at), texts.where(F.col(updated_at) <= mark)
        for name, rows in (("rows", fresh), ("late", late)):
            marks.write_batch(rows, paths[name], number)
            tell(name, number)
        written = [spark.read.schema(rows.schema.add("batch", "long")).parquet(paths[name]).where(F.col("batch") == number) for name, rows in (("rows", fresh), ("late", late))]
        marks.save_mark(*written, updated_at, paths["marks"], number)
        tell("marks", number)

    run_batches(stream, checkpoint, take)


def read_delta(spark: SparkSession, out: str, schema: T.StructType, part: str = "rows") -> DataFrame:
    """Rows (or ``late`` rows) of the complete micro-batches, with their ``batch``."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{out}/{part}")
    return marks.complete(spark, stored, f"{out}/marks")


def read_watermark(spark: SparkSession, out: str) -> DataFrame:
    """One row: the watermark after all complete micro-batches."""
    return marks.marks(spark, f"{out}/marks").agg(F.max("watermark").alias("watermark"))


def stream_watermark(stream: DataFrame, updated_at: str, out: str, checkpoint: str) -> None:
    """Highest timestamp per micro-batch; their maximum is the watermark."""

    def save(batch: DataFrame, number: int) -> None:
        marks.write_batch(batch.agg(F.max(updated_at).alias("watermark")).where("watermark IS NOT NULL"), out, number)

    run_batches(stream, checkpoint, save)


def stream_upsert(
    stream: DataFrame, table: str, checkpoint: str, key: str, updated_at: str, buckets: int, tie_breaker: Sequence[str] = ()
) -> None:
    """Latest row per key kept in a versioned table, one version per micro-batch; a repeated batch is known by its number."""

    def merge(batch: DataFrame, number: int) -> None:
        keyed_table.merge(batch, table, key, updated_at, buckets, tie_breaker, tag=f"batch {number}")

    run_batches(stream, checkpoint, merge)


def stream_changed(
    stream: DataFrame, known: DataFrame, key: str, new_hash: str, old_hash: str, at: str, out: str, checkpoint: str
) -> None:
    """Rows that are new or whose hash differs from the one stored last: a stream-static left join on unique keys."""
    newest = newest_stored(known, key, [old_hash], at)
    lookup = newest.select(F.col(key).alias("_key"), F.col(old_hash).alias("_old"))
    joined = stream.join(lookup, F.col(key) == F.col("_key"), "left")
    kept = joined.where(F.col("_key").isNull() | ~F.col(new_hash).eqNullSafe(F.col("_old"))).drop("_key", "_old")
    query = (
        kept.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_quota(stream: DataFrame, ts: str, out: str, checkpoint: str, lateness: str, after: Callable[[str, int], None] | None = None) -> None:
    """Calls per minute, from which windows of every width add up; calls later than ``lateness`` go to a table of their own.

    A call is late when its minute ended ``lateness`` (an interval such as ``1 hour``) or more before the newest call of
    the micro-batches so far; one without a time counts as late.  Below ``out``: ``minutes`` (calls on time, per minute and micro-batch; they are added up
    when read, so nothing is kept in memory between batches and a minute may be fed by many batches), ``late`` (the late
    calls, whole rows) and ``marks``.  All are written per batch and replaced if the batch is repeated.
    """
    spark = stream.sparkSession
    paths = {name: f"{out}/{name}" for name in ("minutes", "late", "marks")}
    marks.begin(spark, paths["marks"], F.lit(None))
    tell = after or (lambda step, batch: None)

    def count(batch: DataFrame, number: int) -> None:
        mark = marks.mark_before(spark, paths["marks"], number)
        timed = batch.where(F.col(ts).isNotNull()).withColumn("_minute", F.window(F.col(ts).cast("timestamp_ntz"), "1 minute").start)
        late = F.coalesce(F.col("_minute") + F.expr("INTERVAL 1 MINUTE") <= mark - F.expr(f"INTERVAL {lateness}"), F.lit(False))
        per_minute = timed.where(~late).groupBy(F.col("_minute").alias("minute")).agg(F.count(F.lit(1)).alias("calls"), F.max(F.col(ts).cast("timestamp_ntz")).alias("newest"))
        aside = timed.where(late).drop("_minute").unionByName(batch.where(F.col(ts).isNull()))
        marks.write_batch(per_minute, paths["minutes"], number)
        tell("minutes", number)
        marks.write_batch(aside, paths["late"], number)
        tell("late", number)
        here = F.col("batch") == number
        stored = quota_minutes(spark, out).where(here), spark.read.schema("batch long").parquet(paths["late"]).where(here)
        marks.save_mark(*stored, "newest", paths["marks"], number)
        tell("marks", number)

    run_batches(stream, checkpoint, count)


def quota_minutes(spark: SparkSession, out: str) -> DataFrame:
    """Calls on time per minute and micro-batch, as stored."""
    return spark.read.schema("minute timestamp_ntz, calls long, newest timestamp_ntz, batch long").parquet(f"{out}/minutes")


def quota_status(spark: SparkSession, out: str, quotas: Mapping[str, int] = API_QUOTAS) -> DataFrame:
    """Calls per window of each width and whether they exceed its quota, from the complete micro-batches."""
    stored = marks.complete(spark, quota_minutes(spark, out), f"{out}/marks")
    minutes = stored.groupBy("minute").agg(F.sum("calls").alias("calls"))
    return widths_of(minutes, quotas)


def late_calls(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The late calls of the complete micro-batches, as they came."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{out}/late")
    return marks.complete(spark, stored, f"{out}/marks")
