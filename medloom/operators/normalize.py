"""Conforming text deliveries to the typed model."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom import schema
from medloom.functions.casts import as_timestamp, cast_temporal, cast_text, parse_timestamp
from medloom.functions.keys import content_key, site_key

# Column names by which sites send the study id; its value becomes person_id.
STUDY_ID_NAMES = ["connectid", "connect_id"]


@dataclass(frozen=True)
class Normalized:
    """Both sides of one pass over a delivery table.

    ``flagged`` holds the typed columns, ``is_valid``, and for invalid rows
    the delivered text in ``raw``; the other frames are views of it.
    """

    flagged: DataFrame
    columns: list[str]

    @property
    def valid(self) -> DataFrame:
        return self.flagged.filter("is_valid").select(*self.columns)

    @property
    def invalid(self) -> DataFrame:
        return self.flagged.filter("NOT is_valid").select("raw.*")

    def row_counts(self) -> DataFrame:
        return self.flagged.groupBy("is_valid").agg(F.count(F.lit(1)).alias("row_count"))


def study_id_column(columns: list[str]) -> str | None:
    return next((c for c in columns if any(name in c.lower() for name in STUDY_ID_NAMES)), None)


def default_value(field: T.StructField) -> Column:
    """Placeholder for a required column or a concept id, else NULL."""
    kind = field.dataType.simpleString()
    if field.metadata["required"] or field.name.endswith("_concept_id"):
        return F.lit(schema.default_text(field.name, kind))
    return F.lit(None).cast("string")


def typed(text: Column, field: T.StructField, date_format: str, datetime_format: str) -> Column:
    """One delivered column as its model type.

    A missing number or text takes the placeholder, an unreadable one becomes
    NULL; dates take the placeholder in both cases.
    """
    kind = field.dataType.simpleString()
    if kind in ("date", "timestamp_ntz"):
        fmt = date_format if kind == "date" else datetime_format
        return cast_temporal(text, kind, fmt, default_value(field).cast(kind))
    return cast_text(F.coalesce(text, default_value(field)), kind)


def birth_datetime(columns: list[str], datetime_format: str) -> Column:
    """The delivered moment of birth, else midnight of the delivered date parts."""

    def part(name: str, missing: str, width: int) -> Column:
        value = F.col(name) if name in columns else F.lit(None).cast("string")
        return F.lpad(F.coalesce(value, F.lit(missing)), width, "0")

    assembled = F.concat_ws(
        "-", part("year_of_birth", "1900", 4), part("month_of_birth", "1", 2), part("day_of_birth", "1", 2)
    )
    midnight = as_timestamp(F.concat(assembled, F.lit(" 00:00:00")))
    if "birth_datetime" not in columns:
        return midnight
    given = F.col("birth_datetime")
    readers = [as_timestamp(given), midnight]
    if datetime_format:
        readers.insert(0, parse_timestamp(given, datetime_format))
    return F.coalesce(*readers)


def normalize(
    df: DataFrame, table: str, version: str = "5.4", date_format: str = "%Y-%m-%d",
    datetime_format: str = "%Y-%m-%d %H:%M:%S",
) -> Normalized:
    """Type, complete and order the columns of a text table; flag bad rows.

    A row is invalid when a required column that was delivered cannot be read.
    Tables without a delivered identity get a key derived from their content.
    """
    layout = schema.layout(table, version)
    study_id = study_id_column(df.columns)
    typed_columns: dict[str, Column] = {}
    checked: list[str] = []
    for field in layout:
        delivered = study_id if study_id and field.name == "person_id" else field.name
        if table == "person" and field.name == "birth_datetime":
            typed_columns[field.name] = birth_datetime(df.columns, datetime_format)
        elif delivered in df.columns:
            typed_columns[field.name] = typed(F.col(f"`{delivered}`"), field, date_format, datetime_format)
            if field.metadata["required"]:
                checked.append(field.name)
        else:
            typed_columns[field.name] = default_value(field).cast(field.dataType)

    # Each value is read once, in the first select; validity and key build on it.
    raw = {name: f"_raw_{i}" for i, name in enumerate(df.columns)}
    rows = df.select(
        *[value.alias(name) for name, value in typed_columns.items()],
        *[F.col(f"`{name}`").alias(alias) for name, alias in raw.items()],
    )
    valid = reduce(operator.and_, [F.col(name).isNotNull() for name in checked], F.lit(True))
    key = schema.primary_key(table, version)
    values = {name: F.col(name) for name in layout.names}
    if table in schema.SURROGATE_KEY_TABLES:
        values[key] = content_key([name for name in layout.names if name != key])
    flagged = rows.select(
        *[value.alias(name) for name, value in values.items()],
        valid.alias("is_valid"),
        F.when(~valid, F.struct(*[F.col(alias).alias(name) for name, alias in raw.items()])).alias("raw"),
    )
    return Normalized(flagged, layout.names)


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Cast a typed frame to a layout: its columns, its order, missing ones NULL."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout
    ])


def globalize_keys(df: DataFrame, table: str, site: str) -> DataFrame:
    """Replace site-local keys by globally unique ones, in every table that refers to them."""
    present = [c for c in schema.SITE_KEY_COLUMNS if c in df.columns]
    if table in schema.VOCABULARY_TABLES or not present:
        return df
    return df.withColumns({c: site_key(c, site) for c in present})
