"""Partition monitors over (table_name, dt) tagged rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import ladder
from .quality import union_all

# Megabytes assumed per record of each table.
MB_PER_RECORD = {
    "silver_companies": 2.5,
    "silver_apollo_companies": 3.0,
    "silver_apollo_contacts": 2.0,
    "silver_domain_health": 1.5,
    "silver_web_extracts": 5.0,
    "gold_startup_profiles": 4.0,
}
SIZES = [(10000, "VERY_HIGH"), (1000, "HIGH"), (100, "NORMAL"), (1, "LOW")]


def tag_tables(tables: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """One long frame of the given columns with the table name on each row."""
    return union_all([df.select(F.lit(name).alias("table_name"), *columns) for name, df in tables.items()])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table; a table without rows counts 0."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(n).alias("table_name"), "record_count") for n, df in tables.items()]
    )


def partition_status(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_name", "dt").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("created_at").alias("earliest_record"),
        F.max("created_at").alias("latest_record"),
    )


def partition_size(rows: DataFrame, unit: str = "company_key", second: str = "domain") -> DataFrame:
    """Distinct companies and domains per partition and records per company."""
    sizes = rows.groupBy("table_name", "dt").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.countDistinct(unit).alias("unique_companies"),
        F.countDistinct(second).alias("unique_domains"),
    )
    mean = F.round(F.try_divide(F.col("record_count").cast("double"), F.col("unique_companies").cast("double")), 2)
    return sizes.withColumn("avg_records_per_company", mean)


def storage_usage(rows: DataFrame, mb_per_record: Mapping[str, float] = MB_PER_RECORD) -> DataFrame:
    """Estimated size per partition from a per-table factor."""
    factor = F.create_map(*[x for k, v in mb_per_record.items() for x in (F.lit(k), F.lit(v))])
    counts = rows.groupBy("table_name", "dt").agg(F.count(F.lit(1)).alias("record_count"))
    mb = F.round(F.col("record_count") * F.try_element_at(factor, F.col("table_name")), 2)
    return counts.withColumn("estimated_size_mb", mb)


def partition_health(status: DataFrame, as_of: str) -> DataFrame:
    """Size and age category of each partition."""
    today = F.lit(as_of).cast("date")

    def back(days: int):
        return F.date_sub(today, days).cast("string")

    age = (
        F.when(F.col("dt") == back(0), "CURRENT")
        .when(F.col("dt") == back(1), "YESTERDAY")
        .when(F.col("dt") >= back(7), "RECENT")
        .when(F.col("dt") >= back(30), "OLD")
        .otherwise("VERY_OLD")
    )
    return status.select(
        "table_name",
        "dt",
        "record_count",
        ladder("record_count", SIZES, "EMPTY").alias("partition_size_category"),
        age.alias("partition_age_category"),
    )
