"""Files that tasks themselves write or read below the shared folder."""

from __future__ import annotations

import re

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.sources.storage import scratch_path


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or of a plain path."""
    if "://" not in uri:
        uri = "file://" + re.sub("^file:", "", uri)
    return pafs.FileSystem.from_uri(uri)


def stage(df: DataFrame, name: str, group_bytes: int = 16 << 20, rows: int = 20_000) -> str:
    """Write a frame without a shuffle, in files whose row groups a task can hold. Returns the folder."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", "zstd").option("parquet.block.size", group_bytes)
     .option("maxRecordsPerFile", rows).parquet(path))
    return path


def staged_files(spark: SparkSession, path: str) -> DataFrame:
    """One row (file) for each file of a staged frame; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.selectExpr("path AS file")


def carried(df: DataFrame) -> DataFrame:
    """The caller's rows in one column ``row``, so that an operator's own columns cannot meet theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def within(column: str) -> str:
    """Name of a caller's column in carried rows."""
    return f"row.`{column}`"


def given_back(found: DataFrame, columns: list[str]) -> DataFrame:
    """The caller's columns and behind them the new ones, which replace those of their names."""
    new = [c for c in found.columns if c != "row"]
    return found.select(*[F.col(within(c)).alias(c) for c in columns if c not in new], *new)
