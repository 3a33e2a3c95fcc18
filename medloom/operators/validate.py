"""Checks of a delivery's table and column names against the model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medloom import schema
from medloom.operators.metrics import Metric, metric_frame


def name_metrics(table: str, columns: list[str], version: str = "5.4") -> list[Metric]:
    """One metric for the table name and, if it is known, one per column."""
    if table not in schema.tables(version):
        return [Metric(f"Invalid table name: {table}", value_as_string="invalid table name", concept_id=None)]
    known = schema.layout(table, version).names
    out = [Metric(f"Valid table name: {table}", value_as_string="valid table name")]
    for label, names in (
        ("Valid column name", [c for c in columns if c in known]),
        ("Invalid column name", [c for c in columns if c not in known]),
        ("Missing column", [c for c in known if c not in columns]),
    ):
        for name in sorted(names):
            concept_id = None if label.startswith("Invalid") else 0
            out.append(Metric(f"{label}: {table}.{name}", value_as_string=label.lower(), concept_id=concept_id))
    return out


def validate(spark: SparkSession, delivery: dict[str, DataFrame], version: str = "5.4") -> DataFrame:
    """Name metrics of a whole delivery. Reads no rows."""
    metrics = [m for table, df in delivery.items() for m in name_metrics(table, df.columns, version)]
    return metric_frame(spark, metrics)
