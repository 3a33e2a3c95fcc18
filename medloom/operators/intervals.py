"""Merging of date intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_intervals(
    df: DataFrame, keys: list[str], start: str, end: str, gap_days: int, aggregates: list[Column],
) -> DataFrame:
    """Join intervals of a key that overlap or lie within ``gap_days``.

    One sort per key. A new island opens when a start lies past the latest end
    so far. Callers reduce to one interval per key and start first, which
    bounds a key's rows by the days it spans.
    """
    ordered = Window.partitionBy(*keys).orderBy(start, end)
    latest = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col(start) <= F.date_add(latest, gap_days), 0).otherwise(1)
    island = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return (
        df.withColumn("_opens", opens).withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(F.min(start).alias("island_start"), F.max(end).alias("island_end"), *aggregates)
        .drop("_island")
    )


def lag_islands(df: DataFrame, key: str, start: str, end: str, gap_days: int) -> DataFrame:
    """Islands that open when the previous row's end lies too far back.

    Unlike :func:`merge_intervals` only the row just before counts, even when
    an earlier one reaches further. Rows of one start are reduced first: an end
    within reach of its own start never opens an island behind it, so only the
    latest of those matters. What remains is bounded by the days a key spans.
    """
    unreachable = F.when(F.datediff(start, end) > gap_days, F.col(end))
    reduced = df.groupBy(key, start, unreachable.alias("_far")).agg(F.max(end).alias(end))
    ordered = Window.partitionBy(key).orderBy(start, end)
    previous = F.lag(end).over(ordered)
    opens = F.when(previous.isNull() | (F.datediff(start, previous) > gap_days), 1).otherwise(0)
    island = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return (
        reduced.withColumn("_opens", opens).withColumn("_island", island)
        .groupBy(key, "_island")
        .agg(F.min(start).alias("island_start"), F.max(end).alias("island_end"))
        .drop("_island")
    )
