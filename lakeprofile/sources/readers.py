"""File readers.  Schemas are given, never inferred, except where asked for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = str | T.StructType


def read_csv(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """CSV with a header line, double-quoted fields and backslash escapes."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape="\\", multiLine=False)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types from the data (reads the files twice)."""
    return spark.read.csv(path, header=True, inferSchema=True, quote='"', escape="\\")


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-Lines as one text column, the whole line."""
    return spark.read.text(path).withColumnRenamed("value", "raw_json")


def read_json(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_skip_bad(spark: SparkSession, base: str, schema: Schema) -> DataFrame:
    """JSON-Lines below ``date=`` folders; malformed and empty lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(base)


def read_parquet(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """All Parquet files below a folder, partition columns included."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def between_dates(df: DataFrame, start: str, end: str | None = None, column: str = "dt") -> DataFrame:
    """Bounded date range on a partition column; prunes folders."""
    out = df.where(F.col(column) >= start)
    return out if end is None else out.where(F.col(column) <= end)


def newest_file(spark: SparkSession, path: str, schema: Schema, sequence: str = r"(\d+)\D*$") -> DataFrame:
    """Rows of the most recently modified JSON-array file below ``path``.

    Of files of the same time that with the highest number in its name counts
    (``sequence`` captures it; a name without one is before all numbers), then the
    last name.  The times come from a listing of names only; the data read that
    follows opens the one chosen file.
    """
    listing = spark.read.format("binaryFile").load(path).select("path", "modificationTime")
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -1), sequence, 1).try_cast("decimal(38,0)")
    newest = listing.orderBy(F.col("modificationTime").desc(), number.desc_nulls_last(), F.col("path").desc()).first()
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(newest["path"], multiLine=True)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One domain per line: trimmed, blanks dropped."""
    lines = spark.read.text(path).select(F.trim("value").alias("domain"))
    return lines.where(F.col("domain") != "")


def read_table(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """A catalog table, or some of its columns."""
    table = spark.table(name)
    return table.select(*columns) if columns else table


def read_mapped(spark: SparkSession, name: str, shape: Mapping[str, Column]) -> DataFrame:
    """A catalog table brought into another shape: output columns and the expressions they come from.

    Only the table's columns that the shape names are read.
    """
    return spark.table(name).select(*[c.alias(out) for out, c in shape.items()])
