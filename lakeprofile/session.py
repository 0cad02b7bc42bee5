"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs in this package are written for.  All are plain Spark
#: options, so a cluster profile may set them instead.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "lakeprofile", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the package defaults; keyword options win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Python tasks import it there, wherever the driver was started.
    """
    context = spark.sparkContext
    if getattr(context, "_lakeprofile_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lakeprofile-ship-")) / "lakeprofile.zip"  # Spark copies it to the executors
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._lakeprofile_shipped = True


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where driver and
    executors are one machine; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeprofile-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """Fresh, unique folder below the shared root."""
    return f"{shared_root(spark)}/lakeprofile/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: stored in the shared folder, survives executor loss."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file in whatever store its path names; whether it was there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
