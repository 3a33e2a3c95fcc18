"""What a clean-up task added to and removed from a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.keys import row_digest
from medloom.sources.storage import materialize


# Keys are dealt into so many buckets; only those whose content differs are looked at by key.
BUCKETS = 1 << 14


def _counted(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def _digests(df: DataFrame, out: str) -> DataFrame:
    """(bucket, digest): count and order-free sums of two hashes of the keys of each bucket."""
    sums = [F.sum(F.xxhash64(F.lit(seed), "key").cast("decimal(38,0)")) for seed in (1, 2)]
    return df.groupBy("bucket").agg(F.struct(F.count(F.lit(1)).alias("n"), *[x.alias(f"s{i}") for i, x in enumerate(sums)]).alias(out))


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose keys are not the same; of each table only a row for each bucket shuffles."""
    both = _digests(before, "one").join(_digests(after, "two"), "bucket", "full")
    return both.filter(~F.col("one").eqNullSafe(F.col("two"))).select("bucket")


def _keys(df: DataFrame, key: str) -> DataFrame:
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))


def diff_by_key(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows added and removed by primary key, repeats included.

    Both tables are read for a digest of each bucket of keys, and again only
    for the buckets that differ, at most ``BUCKETS`` numbers.
    """
    sides = [_keys(df, key) for df in (before, after)]
    changed = materialize(differing_buckets(*sides), "changed-buckets")
    ones, twos = (df.join(F.broadcast(changed), "bucket", "left_semi").select("key") for df in sides)
    both = _counted(ones, "key", "n_before").join(_counted(twos, "key", "n_after"), "key", "full")
    gained = F.sum(F.when(F.col("n_before").isNull(), F.col("n_after")))
    lost = F.sum(F.when(F.col("n_after").isNull(), F.col("n_before")))
    return both.agg(F.coalesce(gained, F.lit(0)).alias("added"), F.coalesce(lost, F.lit(0)).alias("removed"))


def diff_by_content(before: DataFrame, after: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows added and removed by content, for tables without a key."""
    names = columns or before.columns
    digests = [df.select(row_digest(df, names).alias("row_hash")) for df in (before, after)]
    return diff_by_key(*digests, "row_hash")
