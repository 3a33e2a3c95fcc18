"""The run log: one row per site and delivery with its latest state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.sources.storage import create_once, numbered

KEY = ["site_name", "delivery_date"]
STARTED, RUNNING, COMPLETED, ERROR = "started", "running", "completed", "error"
# What the scheduler reports; it must not hide a message that says more.
GENERIC_FAILURE = "DAG failed"

LOG_SCHEMA = T.StructType([
    T.StructField("site_name", T.StringType()),
    T.StructField("delivery_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("pipeline_start_datetime", T.TimestampNTZType()),
    T.StructField("pipeline_end_datetime", T.TimestampNTZType()),
    T.StructField("file_format", T.StringType()),
    T.StructField("cdm_version", T.StringType()),
    T.StructField("run_id", T.StringType()),
])


class RunLog:
    """The log as a table of numbered snapshots below a folder.

    A commit reads the latest snapshot, applies a change and writes the next
    number, which only one writer can create; one that comes second applies
    its change to the newer snapshot again. A snapshot is small, a row for each
    site and delivery, and is never changed, so readers need no lock.
    """

    def __init__(self, spark: SparkSession, root: str, attempts: int = 20):
        self.spark, self.root, self.attempts = spark, root.rstrip("/"), attempts

    def version(self) -> int:
        """Number of the latest snapshot; 0 if there is none."""
        found = numbered(self.spark, self.root)
        return int(found[-1]) if found else 0

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/{version:012d}")

    def commit(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """Store ``change(log)`` as the next snapshot; returns its number."""
        for _ in range(self.attempts):
            version = self.version()
            if create_once(change(self.read(version)).select(*LOG_SCHEMA.names), f"{self.root}/{version + 1:012d}"):
                return version + 1
        raise RuntimeError(f"{self.root} was changed by others in each of {self.attempts} attempts")


def _latest(updates: DataFrame, on: list[str], moment: str) -> DataFrame:
    """One update per key, the last; of several at one moment the greatest row."""
    others = [c for c in updates.columns if c not in on and c != moment]
    latest = updates.groupBy(*on).agg(F.max(F.struct(moment, *others)).alias("_last"))
    return latest.select(*on, *[F.col(f"_last.{c}").alias(c) for c in updates.columns if c not in on])


def log_started(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Add new deliveries and reset those that run again.

    ``starts`` holds, for each delivery (the last row counts), its key, pipeline_start_datetime,
    file_format, cdm_version, run_id and optionally message.
    """
    starts = _latest(starts, KEY, "pipeline_start_datetime")
    again = log.select(*KEY).withColumn("_known", F.lit(True))
    note = F.col("message") if "message" in starts.columns else F.lit(None)
    fixed = {
        "status": F.lit(STARTED),
        "message": F.when(F.col("_known"), note),
        "pipeline_end_datetime": F.lit(None),
    }
    fresh = starts.join(again, KEY, "left").select(*[
        fixed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA
    ])
    return log.join(starts.select(*KEY), KEY, "left_anti").select(*LOG_SCHEMA.names).unionByName(fresh)


def _update(log: DataFrame, updates: DataFrame, on: list[str], changes: dict[str, Column], unless: Column) -> DataFrame:
    renamed = updates.select(*on, *[F.col(c).alias(f"_{c}") for c in updates.columns if c not in on])
    joined = log.join(renamed.withColumn("_hit", F.lit(True)), on, "left")
    hit = F.coalesce(F.col("_hit") & ~unless, F.lit(False))
    return joined.select(*[
        (F.when(hit, changes[f.name]).otherwise(F.col(f.name)) if f.name in changes else F.col(f.name))
        .cast(f.dataType).alias(f.name) for f in LOG_SCHEMA
    ])


def log_running(log: DataFrame, keys: DataFrame) -> DataFrame:
    """Mark deliveries as running; an earlier end and message go away."""
    changes = {"status": F.lit(RUNNING), "pipeline_end_datetime": F.lit(None), "message": F.lit(None)}
    return _update(log, keys.select(*KEY).distinct(), KEY, changes, F.col("status") == RUNNING)


def log_completed(log: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends``: for each delivery (the last row counts) its pipeline_end_datetime."""
    changes = {
        "status": F.lit(COMPLETED), "pipeline_end_datetime": F.col("_pipeline_end_datetime"), "message": F.lit(None),
    }
    ends = _latest(ends.select(*KEY, "pipeline_end_datetime"), KEY, "pipeline_end_datetime")
    return _update(log, ends, KEY, changes, F.lit(False))


def log_failed(log: DataFrame, errors: DataFrame) -> DataFrame:
    """``errors``: for each run_id (the last row counts) its pipeline_end_datetime and message."""
    keep = (F.coalesce(F.col("message"), F.lit("")) != "") & (F.col("_message") == GENERIC_FAILURE)
    changes = {
        "status": F.lit(ERROR), "pipeline_end_datetime": F.col("_pipeline_end_datetime"),
        "message": F.when(keep, F.col("message")).otherwise(F.col("_message")),
    }
    errors = _latest(errors.select("run_id", "pipeline_end_datetime", "message"), ["run_id"], "pipeline_end_datetime")
    return _update(log, errors, ["run_id"], changes, F.lit(False))


def log_rows(log: DataFrame, site: str, delivery_date) -> DataFrame:
    return log.filter((F.col("site_name") == site) & (F.col("delivery_date") == F.lit(delivery_date)))


def latest_completed(log: DataFrame) -> DataFrame:
    """Latest completed delivery of every site."""
    done = log.filter(F.col("status") == COMPLETED)
    return done.groupBy("site_name").agg(F.max("delivery_date").alias("delivery_date"))
