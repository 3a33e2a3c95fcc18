"""Repair of primary keys that repeat after rows met from several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.keys import content_key, row_digest
from medloom.operators.joins import lookup_join
from medloom.operators.ranking import number_rows
from medloom.sources.storage import materialize

# Copies of one row that a single task writes out.
COPIES_PER_TASK = 1_000_000


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def repair_keys(df: DataFrame, key: str) -> DataFrame:
    """Make the key unique: the first row keeps it, the others get new ones.

    Without repeated keys the frame itself comes back.

    Rows with one key are ordered by their content. Only rows whose key
    repeats are moved; equal copies travel as one row with a count, and
    different rows of one key are numbered bucket by bucket.
    """
    others = [c for c in df.columns if c != key]
    keys = materialize(repeated_keys(df, key).select(key), "repeated-keys")
    if keys.isEmpty():
        return df
    tagged = lookup_join(df, keys.withColumn("_repeats", F.lit(True)), key, bound=keys, narrow=False)
    unique = tagged.filter(F.col("_repeats").isNull()).select(*df.columns)
    repeated = tagged.filter(F.col("_repeats").isNotNull()).select(*df.columns)

    copies = repeated.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    copies = copies.withColumn("_digest", row_digest(df, others))
    numbered = number_rows(copies, [key], F.substring("_digest", 1, 3), ["_digest"], weight="_copies", out="_first")
    chunks = F.sequence(F.lit(0).cast("bigint"), ((F.col("_copies") - 1) / COPIES_PER_TASK).cast("bigint"))
    chunked = numbered.withColumn("_chunk", F.explode(chunks))
    # Without the shuffle one task would write out every copy of a row.
    chunked = chunked.repartition(key, "_digest", "_chunk")
    low = F.col("_chunk") * COPIES_PER_TASK
    high = F.least(low + COPIES_PER_TASK, F.col("_copies")) - 1
    expanded = chunked.withColumn("_copy", F.explode(F.sequence(low, high))).withColumn(
        "_row", F.col("_first") + F.col("_copy")
    )
    repaired = F.when(F.col("_row") == 1, F.col(key)).otherwise(content_key([key, "_row"]))
    fixed = expanded.withColumn(key, repaired).select(*df.columns)
    return unique.unionByName(fixed)
