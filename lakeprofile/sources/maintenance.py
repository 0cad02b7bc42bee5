"""Catalog tables: partitions, retention and comments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Properties the catalog writes itself.
OWN_PROPERTIES = r"^(comment$|transient_lastDdlTime|numFiles|totalSize|option\.|spark\.sql\.)"


def quoted(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_dated_table(spark: SparkSession, name: str, schema: str, location: str, comment: str = "") -> None:
    """External Parquet table partitioned by ``dt``."""
    note = f" COMMENT {quoted(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY (dt){note} LOCATION '{location}'")


def add_partition(spark: SparkSession, name: str, dt: str) -> None:
    """Register one day; repeating it changes nothing."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (dt = '{dt}')")


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register every day folder found at the table location."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def partitions_of(spark: SparkSession, name: str) -> DataFrame:
    listed = spark.sql(f"SHOW PARTITIONS {name}")
    return listed.select(F.regexp_extract("partition", "dt=([^/]+)", 1).alias("dt"))


def drop_old_partitions(spark: SparkSession, name: str, as_of: str, days: int) -> DataFrame:
    """Drop days before ``as_of - days``; returns the days that are kept.

    Only partition names (catalog metadata) reach the driver; all old days go
    in one statement.
    """
    oldest = F.date_sub(F.lit(as_of).cast("date"), days).cast("string")
    expired = [r["dt"] for r in partitions_of(spark, name).where(F.col("dt") < oldest).collect()]
    if expired:
        specs = ", ".join(f"PARTITION (dt = '{d}')" for d in expired)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
    return partitions_of(spark, name)


def set_comments(spark: SparkSession, name: str, table_comment: str, columns: Mapping[str, str]) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {quoted(table_comment)}")
    for column, text in columns.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN {column} COMMENT {quoted(text)}")


def set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def column_comments(spark: SparkSession, name: str) -> DataFrame:
    described = spark.sql(f"DESCRIBE TABLE {name}")
    fields = described.where(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
    return fields.select("col_name", "data_type", F.coalesce("comment", F.lit("")).alias("comment")).distinct()


def catalog_record(spark: SparkSession, name: str) -> DataFrame:
    """What the catalog holds about a table: ``kind`` (table, column, property, partition), ``item``, ``value`` and ``detail``.

    The comment of the table and its columns with type and comment, the properties that were set (not those the catalog
    keeps for itself), and every partition.
    """
    none = F.lit("")
    columns = column_comments(spark, name).select(F.lit("column").alias("kind"), F.col("col_name").alias("item"), F.col("data_type").alias("value"), F.col("comment").alias("detail"))
    listed = spark.sql(f"SHOW TBLPROPERTIES {name}").where(~F.col("key").rlike(OWN_PROPERTIES))
    properties = listed.select(F.lit("property").alias("kind"), F.col("key").alias("item"), "value", none.alias("detail"))
    days = partitions_of(spark, name).select(F.lit("partition").alias("kind"), F.col("dt").alias("item"), none.alias("value"), none.alias("detail"))
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'")
    table = described.select(F.lit("table").alias("kind"), none.alias("item"), F.col("data_type").alias("value"), none.alias("detail"))
    return table.unionByName(columns).unionByName(properties).unionByName(days)


def create_layers(spark: SparkSession, root: str, retention_days: Mapping[str, int]) -> None:
    """Bronze, silver and gold databases with their location and retention."""
    for layer, days in retention_days.items():
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}' "
            f"WITH DBPROPERTIES ('layer' = '{layer}', 'retention_days' = '{days}')"
        )
