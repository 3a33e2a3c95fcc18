"""Merging the deliveries of many sites into one instance."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom import schema
from medloom.functions.keys import name_key

PROVENANCE = ["site", "delivery_date"]


def extract_chunk(df: DataFrame, table: str, site: str, delivery_date: dt.date, site_name: str | None = None) -> DataFrame:
    """A site's table with its provenance; people get their site as care site."""
    if table == "person":
        df = df.withColumn("care_site_id", name_key(F.lit(site_name or site)))
    return df.withColumns({"site": F.lit(site), "delivery_date": F.lit(delivery_date)})


def unite_chunks(chunks: list[DataFrame]) -> DataFrame:
    """All chunks of a table; a column some sites lack is NULL there, one of several types has their common one."""
    if not chunks:
        raise ValueError("no chunks to unite")
    whole = widened([c.schema for c in chunks])
    return reduce(DataFrame.unionByName, [c.select(*[
        (F.col(f"`{f.name}`") if f.name in c.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole]) for c in chunks])


# Numbers from the narrowest to the widest; what stands apart meets as text.
_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
_MOMENTS = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        return T.DecimalType(min(38, max(one.precision - one.scale, other.precision - other.scale) + scale), scale)
    if isinstance(one, T.DecimalType) or isinstance(other, T.DecimalType):
        exact, plain = (one, other) if isinstance(one, T.DecimalType) else (other, one)
        if plain in _NUMBERS[:4]:
            return common_type(exact, T.DecimalType([3, 5, 10, 19][_NUMBERS.index(plain)], 0))
        return T.DoubleType() if plain in _NUMBERS[4:] else T.StringType()
    for ladder in (_NUMBERS, _MOMENTS):
        if one in ladder and other in ladder:
            found = ladder[max(ladder.index(one), ladder.index(other))]
            # A float does not hold all integers of more than 24 bits.
            return T.DoubleType() if found == T.FloatType() else found
    return T.StringType()


def widened(layouts: list[T.StructType]) -> T.StructType:
    """All columns of several layouts in the order of their first appearance, each in its common type."""
    kinds: dict[str, T.DataType] = {}
    for layout in layouts:
        for f in layout:
            kinds[f.name] = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def reconcile(chunks: DataFrame) -> DataFrame:
    """The merged table, without provenance."""
    return chunks.drop(*PROVENANCE)


def delivery_counts(chunks: DataFrame) -> DataFrame:
    """Rows each delivery contributed."""
    return chunks.groupBy(*PROVENANCE).agg(F.count(F.lit(1)).alias("row_count"))


def care_sites(spark: SparkSession, names: DataFrame | list[str]) -> DataFrame:
    """One care site per merged site name."""
    if isinstance(names, list):
        if not names:
            raise ValueError("no site names to build care_site from")
        names = spark.createDataFrame([(n,) for n in names], "site string")
    name = names.columns[0]
    distinct = names.select(F.col(name).alias("care_site_name")).distinct()
    values = {"care_site_id": name_key(F.col("care_site_name")), "care_site_name": F.col("care_site_name")}
    return distinct.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.layout("care_site")
    ])


def merged_source(
    sources: DataFrame, facts: dict[str, str], site_count: int, version: str, vocabulary_version: str,
    release_date: dt.date,
) -> DataFrame:
    """The one-row cdm_source of the merged instance.

    ``facts`` names and describes it; ``{site_count}`` in a text is filled in.
    The source date is the latest of the sites', else the run date.
    """
    latest = sources.agg(
        F.coalesce(F.max(F.col("source_release_date").cast("date")), F.lit(release_date)).alias("source_release_date")
    )
    fixed = {
        "source_release_date": F.col("source_release_date"),
        "cdm_release_date": F.lit(release_date),
        "cdm_version": F.lit(version),
        "cdm_version_concept_id": F.lit(schema.VERSION_CONCEPTS.get(version, 0)),
        "vocabulary_version": F.lit(vocabulary_version),
    }
    texts = {k: F.lit(v.replace("{site_count}", str(site_count))) for k, v in facts.items()}
    values = {**texts, **fixed}
    return latest.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.layout("cdm_source")
    ])
