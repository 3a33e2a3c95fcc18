"""Upgrade of tables from model 5.3 to 5.4."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import schema
from medloom.functions.casts import cast_temporal


def upgrade(df: DataFrame, table: str, source: str, target: str) -> DataFrame | None:
    """The table in the target version, or None if that version dropped it."""
    if source == target:
        return df
    if (source, target) != ("5.3", "5.4"):
        raise ValueError(f"no upgrade from {source} to {target}")
    if table not in schema.tables("5.4"):
        return None
    renamed = {new: old for old, new in schema.RENAMED.get(table, {}).items()}
    added = schema.ADDED.get(table, [])
    if not renamed and not added:
        return df

    def column(field) -> Column:
        if field.name == "cdm_version_concept_id":
            value = F.lit(schema.VERSION_CONCEPTS["5.4"])
        elif field.name in added:
            value = F.lit(None)
        else:
            value = F.col(renamed.get(field.name, field.name))
        return value.cast(field.dataType).alias(field.name) if field.name in added else value.alias(field.name)

    return df.select(*[column(f) for f in schema.layout(table, "5.4")])


def populate_source(
    delivered: DataFrame | None, spark: SparkSession, facts: dict[str, str], delivery_date: dt.date,
    version: str, vocabulary_version: str, date_format: str = "%Y-%m-%d",
) -> DataFrame:
    """The one-row cdm_source of a delivery.

    A single delivered row keeps its descriptions and readable dates; with
    none or several the row is made from ``facts``. Versions always state what
    the data was standardized to.
    """
    layout = schema.layout("cdm_source", "5.4")
    # Two rows at most reach the driver.
    single = delivered is not None and delivered.limit(2).count() == 1
    if single:
        row = delivered
        names = delivered.columns
    else:
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in facts.items()])
        names = list(facts)

    def date(name: str) -> Column:
        text = F.col(name).cast("string") if name in names else F.lit(None).cast("string")
        return cast_temporal(text, "date", date_format, F.lit(delivery_date))

    fixed = {
        "source_release_date": date("source_release_date"),
        "cdm_release_date": date("cdm_release_date") if single else F.lit(delivery_date),
        "cdm_version": F.lit(version),
        "cdm_version_concept_id": F.lit(schema.VERSION_CONCEPTS.get(version, 0)),
        "vocabulary_version": F.lit(vocabulary_version),
    }
    missing = F.lit(None if single else "")
    columns = {f.name: fixed.get(f.name, F.col(f.name) if f.name in names else missing) for f in layout}
    return row.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in layout])


def extraction_date(source: DataFrame, delivery_date: dt.date, date_format: str = "%Y-%m-%d") -> DataFrame:
    """Date the source system was read, else the delivery date."""
    date = cast_temporal(F.col("source_release_date").cast("string"), "date", date_format, F.lit(delivery_date))
    return source.select(date.cast("string").alias("extraction_date")).limit(1)


def standardized_versions(source: DataFrame) -> DataFrame:
    """Model and vocabulary version a delivery was standardized to."""
    return source.select("cdm_version", "vocabulary_version").limit(1)


def delivered_vocabulary_version(vocabulary: DataFrame) -> DataFrame:
    """Version of the delivered vocabulary, kept under the id 'None'."""
    return vocabulary.filter(F.col("vocabulary_id") == "None").select("vocabulary_version").limit(1)
