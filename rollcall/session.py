"""Session helpers: recommended settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "rollcall", **conf: str) -> SparkSession:
    """Session with the settings the operators rely on (UTC clock, AQE on)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates, hours and chunks are all cut on the UTC clock."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="rollcall-")) / "rollcall-core.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """Folder for materialised intermediates, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, it is a folder in the user's home
    on the default file system, which executors share as well.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    return f"{system.getHomeDirectory()}/.rollcall-scratch"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of redoing the
    shuffles, and two consumers are sure to see the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Every scratch path handed out, oldest first.
scratch_made: list[str] = []


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/rollcall/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in this application's part of the shared folder; the part goes when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    scratch_made.append(path)
    return path


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch whose readers are done."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has materialised; call it when results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
