"""Row numbers within groups of any size.

A plain window sorts a whole group in one task. Here rows are first cut into
ordered buckets; bucket sizes give each bucket its starting number, and the
window only ever sorts one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame, group: list[str], bucket: Column, order: list[str], weight: str | None = None, out: str = "_n",
) -> DataFrame:
    """Add the 1-based position of each row within its group.

    ``bucket`` must never decrease along ``order``; neither it nor the group
    may be NULL. With ``weight`` a row stands for that many rows and gets the
    position of its first.
    """
    size = F.col(weight) if weight else F.lit(1).cast("bigint")
    rows = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    sizes = rows.groupBy(*keys).agg(F.sum(size).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_within", F.coalesce(F.sum(size).over(within), F.lit(0)))
        .join(starts, keys)
        .withColumn(out, F.col("_start") + F.col("_within") + 1)
        .drop("_bucket", "_within", "_start")
    )
