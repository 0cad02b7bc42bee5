"""A table with one row per key, kept in versions.

Rows lie in hash buckets of their key.  A version is a manifest: for each bucket
the folder that holds its rows.  A merge writes new folders for the buckets it
touches, under the number of the new version, and then the manifest, which names
the new folders and the old ones of all other buckets.  A manifest is one file
and appears whole or not at all, in the single rename that ends its write; the
newest one is the table.  So a reader sees a version or the next, never part of
one, and a writer that dies leaves folders no manifest names (``vacuum`` removes
them) and a table that is as it was.  Two writers of one version do not both
succeed: the second finds the folder of its manifest taken.

Large buckets are written by several tasks, dealt by a second hash, into several
files.  A merge may be tagged (with the number of a micro-batch, say); one whose
tag the newest version carries has been done and is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, remove_path
from .ordering import keep_first

FILE_ROWS = 1_000_000  # rows a task writes at most, about
MANIFEST = "bucket int, folder string, rows long, tag string, version long"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per version and bucket; bucket -1 holds the tag and stands for an empty table."""
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def newest(spark: SparkSession, path: str) -> int:
    return manifests(spark, path).agg(F.max("version")).first()[0]


def _write_version(rows: DataFrame, path: str, key: str, buckets: int, version: int, kept: DataFrame | None, tag: str | None, file_rows: int) -> None:
    """Folders of the buckets of ``rows`` (on disk already), then the manifest of the version."""
    placed = rows.withColumn("bucket", bucket_of(key, buckets))
    sizes = cut_lineage(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_files", F.ceil(F.col("_n") / file_rows).cast("int")))
    tasks = sizes.agg(F.coalesce(F.sum("_files"), F.lit(1))).first()[0]
    # at most ``buckets`` rows
    dealt = placed.join(F.broadcast(sizes.select("bucket", "_files")), "bucket").withColumn("_file", F.pmod(F.hash(key), F.col("_files")))
    folder = f"{path}/data/version={version}"
    writer = dealt.repartition(tasks, "bucket", "_file").select(*rows.columns, "bucket").write.mode("overwrite")  # what a dead writer left
    writer.partitionBy("bucket").parquet(folder)
    new = sizes.select("bucket", F.concat(F.lit(f"version={version}/bucket="), "bucket").alias("folder"), F.col("_n").alias("rows"))
    every = new if kept is None else new.unionByName(kept.join(F.broadcast(new.select("bucket")), "bucket", "left_anti"))
    spark = rows.sparkSession
    head = spark.range(1).select(F.lit(-1).alias("bucket"), F.lit(None).cast("string").alias("folder"), F.lit(0).cast("long").alias("rows"))
    listed = every.unionByName(head).withColumn("tag", F.lit(tag).cast("string")).coalesce(1)
    listed.write.mode("errorifexists").json(f"{path}/manifest/version={version}")


def create(rows: DataFrame, path: str, key: str, buckets: int, file_rows: int = FILE_ROWS) -> None:
    """Version 0; ``rows`` have one row per key, or none."""
    _write_version(cut_lineage(rows), path, key, buckets, 0, None, None, file_rows)


def read(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The newest version, or an older one that has not been vacuumed."""
    number = newest(spark, path) if version is None else version
    listed = manifests(spark, path).where((F.col("version") == number) & F.col("folder").isNotNull())
    folders = [f"{path}/data/{r['folder']}" for r in listed.select("folder").collect()]  # one per bucket
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def merge(
    updates: DataFrame, path: str, key: str, updated_at: str, buckets: int, tie_breaker: Sequence[str] = (), tag: str | None = None, file_rows: int = FILE_ROWS
) -> int:
    """Latest row per key of the table and ``updates``; the number of the version that has them.

    Only the buckets of the updates' keys are read and written.
    """
    spark = updates.sparkSession
    number = newest(spark, path)
    listed = cut_lineage(manifests(spark, path).where(F.col("version") == number).drop("version"))
    if tag is not None and not listed.where(F.col("tag") == tag).isEmpty():
        return number
    order = [F.col(updated_at).desc(), *[F.col(t).desc() for t in tie_breaker]]
    fresh = cut_lineage(keep_first(updates, [key], order))
    touched = fresh.select(bucket_of(key, buckets).alias("bucket")).distinct()  # at most ``buckets`` rows
    kept = listed.where(F.col("folder").isNotNull()).drop("tag")
    folders = [f"{path}/data/{r['folder']}" for r in kept.join(F.broadcast(touched), "bucket", "left_semi").select("folder").collect()]
    merged = fresh
    if folders:
        old = spark.read.schema(updates.schema).parquet(*folders)
        merged = keep_first(old.unionByName(fresh), [key], order)
    _write_version(cut_lineage(merged), path, key, buckets, number + 1, kept, tag, file_rows)
    return number + 1


def vacuum(spark: SparkSession, path: str, versions: int = 2) -> list[str]:
    """Remove what the newest ``versions`` manifests do not name, older manifests first; the removed folders.

    Run it while nothing merges: a merge's folders have no manifest yet.
    """
    number = newest(spark, path)
    listed = manifests(spark, path)
    named = {r["folder"] for r in listed.where((F.col("version") > number - versions) & F.col("folder").isNotNull()).select("folder").distinct().collect()}
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [f"manifest/version={r['version']}" for r in listed.where(F.col("version") <= number - versions).select("version").distinct().collect()]
    for version in files.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/data")):
        buckets = [f"{version.getPath().getName()}/{b.getPath().getName()}" for b in files.listStatus(version.getPath()) if b.isDirectory()]
        stale = [b for b in buckets if b not in named]
        gone += [f"data/{version.getPath().getName()}"] if len(stale) == len(buckets) else [f"data/{b}" for b in stale]
    for folder in gone:
        remove_path(spark, f"{path}/{folder}")
    return gone
