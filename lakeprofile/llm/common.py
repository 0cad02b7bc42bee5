"""Words, row identity and tables, as the operators of this folder use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def split_words(text: Column) -> Column:
    """Words of a text that is not null: maximal runs of characters other than blanks."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def doc_rows(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` alone, so that no other column can clash."""
    return docs.select(F.col("doc_id"), whole("text").alias("text"))


def text_key(text: Column) -> Column:
    """64-bit digest of a text; with ``doc_id`` it names a row, and equal rows have equal results."""
    return F.xxhash64(text)


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_key"] == b["_key"])


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Ship the package, and let Python tasks take ``rows`` texts at a time, so that a worker's arrays stay small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
