"""Quality metrics as rows of one report frame.

Counts that look up a concept or a person are taken per id first and joined
after, so a frequent id costs no more than a rare one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom import schema

NO_CONCEPT = "No matching concept"
SOURCE_NOT_CAPTURED = "Source vocabulary not captured in the model"
# Type concept of every report row.
METRIC_TYPE = 32880

METRIC_SCHEMA = T.StructType([
    T.StructField("metadata_concept_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("value_as_string", T.StringType()),
    T.StructField("value_as_concept_id", T.IntegerType()),
    T.StructField("value_as_number", T.DoubleType()),
])

# Tables whose concept fields are broken down by vocabulary.
_BY_VOCABULARY = [*schema.HARMONIZED_TABLES, "person", "visit_detail", "death", "care_site", "provider",
                  "payer_plan_period", "cost"]


@dataclass(frozen=True)
class Metric:
    """A metric known without reading data."""

    name: str
    value_as_string: str | None = None
    value_as_number: float | None = None
    value_as_concept_id: int | None = None
    concept_id: int | None = 0


def metric_frame(spark: SparkSession, metrics: list[Metric]) -> DataFrame:
    rows = [(m.concept_id, m.name, m.value_as_string, m.value_as_concept_id, m.value_as_number) for m in metrics]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def as_metrics(
    df: DataFrame, name: Column, text: Column | None = None, number: Column | None = None,
    concept: Column | None = None, about: Column | None = None,
) -> DataFrame:
    """Turn each row of a result into a metric."""
    values = {
        "metadata_concept_id": about if about is not None else F.lit(0), "name": name, "value_as_string": text,
        "value_as_concept_id": concept, "value_as_number": number,
    }
    return df.select(*[
        (values[f.name] if values[f.name] is not None else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in METRIC_SCHEMA
    ])


def finish_report(metrics: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Complete metric rows to the nine columns of the metadata table.

    A metric that is about no concept has the concept 0.
    """
    metrics = metrics.fillna(0, ["metadata_concept_id", "value_as_concept_id"])
    identity = F.xxhash64("name", "value_as_string", "value_as_concept_id", "value_as_number")
    return metrics.select(
        F.pmod(identity, F.lit(2**31 - 1)).cast("int").alias("metadata_id"), "metadata_concept_id",
        F.lit(METRIC_TYPE).alias("metadata_type_concept_id"), "name", "value_as_string", "value_as_concept_id",
        "value_as_number", F.lit(run_at.date()).alias("metadata_date"),
        F.lit(run_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("metadata_datetime"),
    )


def unite(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---- concept fields ------------------------------------------------------------


def type_field(table: str) -> str | None:
    return next((n for n in schema.layout(table).names if n.endswith("_type_concept_id")), None) \
        if table not in schema.VOCABULARY_TABLES + ["metadata", "cohort_definition"] else None


def vocabulary_fields(table: str) -> list[tuple[str, str | None]]:
    """(concept field, its source field if the model has one)."""
    if table not in _BY_VOCABULARY:
        return []
    sources = dict(schema.concept_pairs(table))
    skipped = ("_source_concept_id", "_type_concept_id", "_event_field_concept_id")
    return [(n, sources.get(n)) for n in schema.layout(table).names
            if n.endswith("_concept_id") and not n.endswith(skipped)]


def concept_usage(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows per (field, concept) over all fields in one scan."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("concept_id")) for f in fields])
    return (
        df.select(F.explode(entries).alias("e")).select("e.*")
        .groupBy("field", "concept_id").agg(F.count(F.lit(1)).alias("n"))
    )


def type_breakdown(usage: DataFrame, concept: DataFrame) -> DataFrame:
    """Rows by type concept, most frequent first."""
    named = concept.select("concept_id", "concept_name")
    return usage.join(named, "concept_id", "left").select(
        "field", F.coalesce("concept_id", F.lit(0)).alias("type_concept_id"),
        F.coalesce("concept_name", F.lit(NO_CONCEPT)).alias("concept_name"), F.col("n").alias("record_count"),
    ).orderBy(F.desc("record_count"), "field", "type_concept_id")


def vocabulary_breakdown(usage: DataFrame, concept: DataFrame) -> DataFrame:
    """Rows by field and vocabulary of the concept."""
    named = concept.select("concept_id", "vocabulary_id")
    joined = usage.join(named, "concept_id", "left")
    return joined.groupBy("field", F.coalesce("vocabulary_id", F.lit(NO_CONCEPT)).alias("vocabulary_id")).agg(
        F.sum("n").alias("record_count")
    )


def invalid_concepts(usage: DataFrame, concept: DataFrame) -> DataFrame:
    """Rows per field whose concept is given, not zero and not in the vocabulary."""
    known = concept.select("concept_id").distinct().withColumn("known", F.lit(True))
    bad = (F.col("concept_id") != 0) & F.col("known").isNull()
    return usage.join(known, "concept_id", "left").groupBy("field").agg(
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("invalid_count")
    )


# ---- dates, counts, people -----------------------------------------------------


def default_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Placeholder values per date column, all columns in one aggregate."""
    types = dict(df.dtypes)

    def defaults(column: str) -> Column:
        placeholder = F.lit(schema.DEFAULTS["date"]).cast(types[column])
        return F.coalesce(F.sum(F.when(F.col(column) == placeholder, 1)), F.lit(0)).alias(column)

    counted = df.agg(*[defaults(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("default_count")) for c in columns])
    return counted.select(F.explode(pairs).alias("e")).select("e.*")


def rows_per_year(df: DataFrame, column: str, until: dt.date) -> DataFrame:
    """Rows per calendar year from the placeholder date to the delivery."""
    day = F.col(column)
    kept = df.filter((day >= F.lit(schema.DEFAULTS["date"]).cast("date")) & (day <= F.lit(until)))
    return kept.groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("row_count"))


def row_counts(spark: SparkSession, delivery: dict[str, DataFrame], version: str = "5.4") -> DataFrame:
    """Rows of every table of the model, 0 for tables that were not delivered."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")
        for table, df in delivery.items() if table in schema.tables(version)
    ]
    absent = [(t, 0) for t in schema.tables(version) if t not in delivery]
    empty = spark.createDataFrame(absent, "table_name string, row_count bigint")
    return unite([*counted, empty])


def orphan_rows(df: DataFrame, person: DataFrame) -> DataFrame:
    """Rows whose person is missing from the person table."""
    per_person = df.groupBy("person_id").agg(F.count(F.lit(1)).alias("n"))
    orphans = per_person.filter("person_id IS NOT NULL").join(
        person.select("person_id").distinct(), "person_id", "left_anti"
    )
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violation_count"))
