"""Where intermediate tables live."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


# Below it, a local session that names no folder gets one of its own.
LOCAL_FOLDER = "/tmp/medloom-scratch"


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir``.

    Only a local session may do without the setting. What is written below
    ``medloom/`` there is scratch; whoever runs the jobs clears it.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(f"{LOCAL_FOLDER}/{context.applicationId}")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing was written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/medloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back, so that later steps start from the result.

    Survives the loss of executors, unlike a cache.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_once(df: DataFrame, path: str) -> bool:
    """Write a small frame unless the path has been completed; whether this call did.

    The rows are written beside it and the folder renamed into place: of
    several writers one succeeds, and a reader sees all of it or nothing. In
    stores that copy folders instead, readers wait for the marker of success
    (``read_completed``).
    """
    spark = df.sparkSession
    jvm = spark._jvm
    beside = f"{path}.{uuid.uuid4().hex}"
    # Not coalesce, by which one task would do all the work since the last shuffle, not the writing only.
    df.repartition(1).write.parquet(beside)
    place, made = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(beside)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if is_completed(spark, path):
        system.delete(made, True)
        return False
    # A rename onto an existing folder moves into it; the store's own word on existence decides.
    if system.exists(place) or not system.rename(made, place):
        system.delete(made, True)
        return False
    moved_into = jvm.org.apache.hadoop.fs.Path(place, made.getName())
    if system.exists(moved_into):
        system.delete(moved_into, True)
        return False
    return True


def is_completed(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def read_completed(spark: SparkSession, path: str) -> DataFrame | None:
    """A frame whose writing was completed, or None."""
    return spark.read.parquet(path) if is_completed(spark, path) else None


def numbered(spark: SparkSession, folder: str) -> list[str]:
    """Names of the completed folders in a folder, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())
    return [n for n in names if "." not in n and is_completed(spark, f"{folder}/{n}")]
