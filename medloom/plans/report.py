"""The quality report of a delivery or a merge."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import schema
from medloom.operators import harmonize as h
from medloom.operators import metrics as m
from medloom.operators import participants as p
from medloom.sources.storage import materialize

STUDY_STATUSES = ["Verified", "Duplicate", "Not Yet Verified", "Cannot be Verified", "No Longer Enrolling",
                  "Outreach Timed Out"]
_STATUS_KINDS = {
    "verified_status": "Study status",
    "hipaa_revoked": "HIPAA revoked status",
    "consent_withdrawn": "Consent withdrawn status",
    "data_destruction_requested": "Data destruction status",
}
_UNMATCHED = "Delivered study ids not found in registry"
_UNDELIVERED = "Number of eligible registered people not in delivery"
_BREAKDOWN = "Registry breakdown"


@dataclass(frozen=True)
class Delivery:
    """What a report is made from."""

    spark: SparkSession
    tables: dict[str, DataFrame]
    concept: DataFrame
    delivery_date: dt.date
    facts: dict[str, str | None] = field(default_factory=dict)


def _named(prefix: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix), *[F.col(x) if i % 2 == 0 else F.lit(x) for i, x in enumerate(parts)])


# ---- facts ---------------------------------------------------------------------


def facts(delivery: Delivery) -> DataFrame:
    """Names, versions and dates of the delivery; versions also as concepts."""
    versions = ("Delivered CDM version", "Standardized to CDM version")
    return m.metric_frame(delivery.spark, [
        m.Metric(name, value, value_as_concept_id=schema.VERSION_CONCEPTS.get(value, 0) if name in versions else 0)
        for name, value in {"Delivery date": delivery.delivery_date.isoformat(), **delivery.facts}.items()
    ])


# ---- what the tables hold --------------------------------------------------------


@dataclass(frozen=True)
class Survey:
    """All that the metrics of a delivery are made from, by two aggregates a table.

    ``concepts``: rows by (table_name, field, concept_id) over all concept
    fields, and over person_id as if it were one. ``days``: rows by
    (table_name, year, in_range), with the placeholder dates among them.
    """

    concepts: DataFrame
    days: DataFrame


def _fields(table: str) -> list[str]:
    """Concept fields that a metric looks at."""
    kind = m.type_field(table)
    pairs = [x for pair in m.vocabulary_fields(table) for x in pair if x]
    return list(dict.fromkeys([*pairs, *([kind] if kind else [])]))


def survey(delivery: Delivery) -> Survey:
    known = {t: df for t, df in delivery.tables.items() if t in schema.tables()}
    concepts, days = [], []
    for table, df in known.items():
        present = [f for f in [*_fields(table), "person_id"] if f in df.columns]
        if present:
            counted = m.concept_usage(df.select(*[F.col(f).cast("bigint").alias(f) for f in present]), present)
            concepts.append(counted.select(F.lit(table).alias("table_name"), "*"))
        days.append(_days(table, df, delivery.delivery_date))
    spark = delivery.spark
    nothing = spark.createDataFrame([], "table_name string, field string, concept_id bigint, n bigint")
    no_days = spark.createDataFrame(
        [], "table_name string, year int, in_range boolean, n bigint, defaults array<struct<field:string,n:bigint>>")
    return Survey(m.unite([nothing, *concepts]), m.unite([no_days, *days]))


def _days(table: str, df: DataFrame, until: dt.date) -> DataFrame:
    """Rows by calendar year, from the placeholder date to the delivery or not, and placeholders per date column."""
    kinds = dict(df.dtypes)
    dated = [c for c in df.columns if kinds[c] in ("date", "timestamp_ntz", "timestamp")]
    event = schema.EVENT_DATE.get(table)
    day = F.col(event) if event in df.columns else F.lit(None).cast("date")
    kept = (day >= F.lit(schema.DEFAULTS["date"]).cast("date")) & (day <= F.lit(until))
    placeholders = [
        F.sum((F.col(c) == F.lit(schema.DEFAULTS["date"]).cast(kinds[c])).cast("bigint")).alias(f"_default_{i}")
        for i, c in enumerate(dated)
    ]
    grouped = df.groupBy(F.year(day).alias("year"), F.coalesce(kept, F.lit(False)).alias("in_range")).agg(
        F.count(F.lit(1)).alias("n"), *placeholders)
    entries = [F.struct(F.lit(c).alias("field"), F.coalesce(F.col(f"_default_{i}"), F.lit(0)).cast("bigint").alias("n"))
               for i, c in enumerate(dated)]
    empty = F.array().cast("array<struct<field:string,n:bigint>>")
    return grouped.select(
        F.lit(table).alias("table_name"), "year", "in_range", "n", (F.array(*entries) if entries else empty).alias("defaults"))


def _used(found: Survey, fields: list[tuple[str, str]]) -> DataFrame:
    """Rows per (table.field, concept) of the named fields."""
    wanted = F.concat_ws(".", "table_name", "field")
    return found.concepts.filter(wanted.isin([f"{t}.{f}" for t, f in fields])).select(
        wanted.alias("field"), "concept_id", "n")


def _present(delivery: Delivery, fields: Callable[[str], list[str]]) -> list[tuple[str, str]]:
    return [(t, f) for t, df in delivery.tables.items() if t in schema.tables() for f in fields(t) if f in df.columns]


# ---- concepts ------------------------------------------------------------------


def type_breakdown(delivery: Delivery, found: Survey) -> DataFrame:
    kinds = _present(delivery, lambda t: [x for x in [m.type_field(t)] if x])
    rows = m.type_breakdown(_used(found, kinds).withColumn("field", F.substring_index("field", ".", 1)), delivery.concept)
    kind = F.col("type_concept_id")
    return m.as_metrics(rows, _named("Type concept breakdown: ", "field"), F.col("concept_name"),
                        F.col("record_count"), kind, kind)


def vocabulary_breakdown(delivery: Delivery, found: Survey) -> DataFrame:
    """Target and source vocabularies of every concept field."""
    pairs = [(t, c, s) for t in delivery.tables if t in schema.tables() for c, s in m.vocabulary_fields(t)
             if c in delivery.tables[t].columns]
    if not pairs:
        return m.metric_frame(delivery.spark, [])
    names = {f"{t}.{c}": f"Target vocabulary breakdown: {t}.{c}" for t, c, _ in pairs}
    names |= {f"{t}.{s}": f"Source vocabulary breakdown: {t}.{c}" for t, c, s in pairs if s}
    rows = m.vocabulary_breakdown(_used(found, [(t, x) for t, c, s in pairs for x in (c, s) if x]), delivery.concept)
    labels = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    counted = m.as_metrics(rows, labels[F.col("field")], F.col("vocabulary_id"), F.col("record_count"), F.lit(0))
    missing = [m.Metric(f"Source vocabulary breakdown: {t}.{c}", m.SOURCE_NOT_CAPTURED, None, 0)
               for t, c, s in pairs if not s]
    return counted.unionByName(m.metric_frame(delivery.spark, missing))


def invalid_concepts(delivery: Delivery, found: Survey) -> DataFrame:
    """Unknown concepts per concept and type field, also where there are none."""

    def fields(table: str) -> list[str]:
        kind = m.type_field(table)
        return [c for c, _ in m.vocabulary_fields(table)] + ([kind] if kind else [])

    checked = _present(delivery, fields)
    if not checked:
        return m.metric_frame(delivery.spark, [])
    rows = m.invalid_concepts(_used(found, checked), delivery.concept)
    named = delivery.spark.createDataFrame([(f"{t}.{f}",) for t, f in checked], "field string")
    return m.as_metrics(named.join(rows, "field", "left"), _named("Invalid concept_id count: ", "field"), F.col("field"),
                        F.coalesce("invalid_count", F.lit(0)), F.lit(0))


# ---- dates, counts, people -----------------------------------------------------


def default_dates(delivery: Delivery, found: Survey) -> DataFrame:
    """Placeholders per date column, also of tables without rows."""
    kinds = ("date", "timestamp_ntz", "timestamp")
    dated = [(t, c) for t, df in delivery.tables.items() if t in schema.tables() for c, k in df.dtypes if k in kinds]
    if not dated:
        return m.metric_frame(delivery.spark, [])
    counted = found.days.select("table_name", F.explode("defaults").alias("d")).groupBy(
        "table_name", F.col("d.field").alias("field")).agg(F.sum("d.n").alias("n"))
    named = delivery.spark.createDataFrame(dated, "table_name string, field string")
    rows = named.join(counted, ["table_name", "field"], "left")
    return m.as_metrics(rows, _named("Date/datetime default value count: ", "table_name", ".", "field"),
                        number=F.coalesce("n", F.lit(0)))


def person_integrity(delivery: Delivery, found: Survey) -> DataFrame:
    """Rows without a person, per table that has any rows."""
    if "person" not in delivery.tables:
        return m.metric_frame(delivery.spark, [])
    people = found.concepts.filter("field = 'person_id'").select("table_name", F.col("concept_id").alias("person_id"), "n")
    known = people.filter("table_name = 'person'").select("person_id").distinct().withColumn("known", F.lit(True))
    # One join with the people for all tables; per table a person comes once.
    counted = people.filter("table_name != 'person'").join(known, "person_id", "left")
    missing = F.col("known").isNull() & F.col("person_id").isNotNull()
    rows = counted.groupBy("table_name").agg(F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("violations"))
    return m.as_metrics(rows, _named("Person_id referential integrity violation count: ", "table_name"),
                        F.col("table_name"), F.col("violations"), F.lit(0))


def final_counts(delivery: Delivery, found: Survey) -> DataFrame:
    """Rows of every table of the model, 0 for tables that were not delivered."""
    counted = found.days.groupBy("table_name").agg(F.sum("n").alias("row_count"))
    named = delivery.spark.createDataFrame([(t,) for t in schema.tables()], "table_name string")
    rows = named.join(counted, "table_name", "left")
    return m.as_metrics(rows, _named("Final row count: ", "table_name"), F.col("table_name"),
                        F.coalesce("row_count", F.lit(0)), F.lit(0))


def time_series(delivery: Delivery, found: Survey) -> DataFrame:
    """Rows per calendar year from the placeholder date to the delivery."""
    rows = found.days.filter("in_range")
    label = F.concat(F.col("table_name"), F.lit("."), F.col("year").cast("string"))
    return m.as_metrics(rows, F.concat(F.lit("Time series row count: "), label), label, F.col("n"), F.lit(0))


# ---- steps of the pipeline -----------------------------------------------------


def normalization(counts: DataFrame, table: str) -> DataFrame:
    """``counts``: rows by is_valid; both metrics exist even if one side is empty."""
    sides = F.explode(F.array(
        F.struct(F.lit(f"Valid row count: {table}").alias("name"), F.col("valid").alias("n")),
        F.struct(F.lit(f"Invalid row count: {table}").alias("name"), F.col("invalid").alias("n")),
    )).alias("side")
    total = counts.agg(
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("row_count"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(~F.col("is_valid"), F.col("row_count"))), F.lit(0)).alias("invalid"),
    ).select(sides)
    return m.as_metrics(total, F.col("side.name"), number=F.col("side.n"))


def removals(counts: DataFrame, table: str) -> DataFrame:
    labels = [
        (f"Number of rows removed due to missing person_id values: {table}", "unknown_identifier_count"),
        (f"Number of rows removed due to identifier not in registry: {table}", "identifier_not_in_registry_count"),
        (f"Number of rows removed due to exclusion rules: {table}", "exclusion_rules_count"),
    ]
    if table == "person":
        labels.insert(0, ("Number of persons with missing person_id", "unknown_identifier_count"))
    entries = F.array(*[F.struct(F.lit(label).alias("name"), F.col(c).alias("n")) for label, c in labels])
    return m.as_metrics(counts.select(F.explode(entries).alias("e")), F.col("e.name"), number=F.col("e.n"))


def harmonization(harmonized: DataFrame, table: str, key: str) -> DataFrame:
    """Where rows went, by which step, into how many targets, and who stayed; one pass over the rows."""
    # Fixed values of the report: how its metrics are named.
    names = {
        h.TRANSITION: f"table transition: {table} to ", h.STATUS_COUNT: f"status: {table} - ",
        h.CARDINALITY: f"same-table mapping: {table} - 1:", h.DISPOSITION: f"row disposition: {table} - ",
    }
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("kind")]
    name = F.concat(F.lit("Vocab harmonization "), label, F.col("label"))
    return m.as_metrics(h.summary(harmonized, table, key), name, number=F.col("row_count"))


def secondary_backfill(counts: DataFrame, table: str) -> DataFrame:
    return m.as_metrics(counts, _named(f"Vocab harmonization secondary backfill: {table} - ", "concept_column"),
                        number=F.col("row_count"))


def _breakdown_name() -> Column:
    labels = F.create_map(*[F.lit(x) for pair in _STATUS_KINDS.items() for x in pair])
    return F.concat(F.lit(f"{_BREAKDOWN}: "), labels[F.col("status_kind")], F.lit(" ("), F.col("status_value"), F.lit(")"))


def registry(
    tables: dict[str, DataFrame], registered: DataFrame, invalid: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Counts of delivered people against the registry; ``registry_ids`` has the ids behind them."""
    person = tables["person"]
    parts = [
        m.as_metrics(p.status_breakdown(registered, person), _breakdown_name(), number=F.col("patient_count"),
                     concept=F.col("status_concept_id")),
        m.as_metrics(p.patient_count(p.undelivered_ids(registered, person)), F.lit(_UNDELIVERED),
                     number=F.col("patient_count")),
    ]
    for table, df in tables.items():
        if "person_id" in df.columns:
            rows = p.patient_count(p.unmatched_ids(df, registered, (invalid or {}).get(table)))
            parts.append(m.as_metrics(rows, F.lit(f"{_UNMATCHED}: {table}"), number=F.col("patient_count")))
    return m.unite(parts)


def registry_ids(
    tables: dict[str, DataFrame], registered: DataFrame, invalid: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(name, id): the ids behind each metric of ``registry`` that names people, as text."""
    person = tables["person"]
    parts = [
        p.status_ids(registered, person).select(_breakdown_name().alias("name"), F.col("person_id").cast("string").alias("id")),
        p.undelivered_ids(registered, person).select(
            F.lit(_UNDELIVERED).alias("name"), F.col("connect_id").cast("string").alias("id")),
    ]
    for table, df in tables.items():
        if "person_id" in df.columns:
            ids = p.unmatched_ids(df, registered, (invalid or {}).get(table))
            parts.append(ids.select(F.lit(f"{_UNMATCHED}: {table}").alias("name"), F.col("unmatched_id").alias("id")))
    return m.unite(parts).distinct()


def merge(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Provenance of a merge from the rows per delivery."""
    sites = m.as_metrics(counts.select("site").distinct(), F.lit("Merge source site"), F.col("site"), concept=F.lit(0))
    label = F.concat(F.col("site"), F.lit("__"), F.col("delivery_date").cast("string"))
    per_delivery = m.as_metrics(
        counts, F.lit("Merge source delivery row count"), label, F.col("row_count"), F.lit(0))
    total = counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    return m.unite([sites, per_delivery, m.as_metrics(
        total, F.lit("Merge total row count"), number=F.col("n"), concept=F.lit(0))])


# ---- the whole -----------------------------------------------------------------

ARTIFACTS: dict[str, Callable[[Delivery, Survey], DataFrame]] = {
    "metadata": lambda delivery, _: facts(delivery),
    "type_concept_breakdown": type_breakdown,
    "vocabulary_breakdown": vocabulary_breakdown,
    "date_datetime_defaults": default_dates,
    "invalid_concept_ids": invalid_concepts,
    "person_id_integrity": person_integrity,
    "final_row_counts": final_counts,
    "time_series": time_series,
}


def artifact(delivery: Delivery, kind: str) -> DataFrame:
    """One kind of metric."""
    if kind not in ARTIFACTS:
        raise ValueError(f"unknown artifact {kind}; known: {', '.join(ARTIFACTS)}")
    return ARTIFACTS[kind](delivery, survey(delivery))


def consolidate(parts: list[DataFrame], run_at: dt.datetime) -> DataFrame:
    """Metrics made one kind at a time, as rows of the metadata table."""
    return m.finish_report(m.unite(parts), run_at)


def generate(delivery: Delivery, earlier: list[DataFrame], run_at: dt.datetime) -> DataFrame:
    """All metrics with those of earlier steps, as rows of the metadata table. Each table is read twice."""
    found = survey(delivery)
    found = Survey(materialize(found.concepts, "report-concepts"), materialize(found.days, "report-days"))
    return consolidate([*earlier, *[make(delivery, found) for make in ARTIFACTS.values()]], run_at)


def study_summary(spark: SparkSession, metrics: DataFrame, ids: DataFrame) -> DataFrame:
    """Lines of the plain-text summary: (line_no, id, line).

    A line with a count has no id; the ids it counts follow, one to a line.
    Status labels match without regard to case, as the registry writes one of
    them differently.
    """
    tables = sorted(t for t in schema.tables() if "person_id" in schema.layout(t).names)

    def breakdown(kind: str, status: str) -> str:
        return f"{_BREAKDOWN}: {kind} ({status})"

    # (metric, text before the count, text after it, whether ids follow)
    wanted = [("Valid row count: person", "Person record count: ", "", False)]
    wanted.append(("*unmatched", "Delivered study ids not found in registry (", "):", False))
    wanted += [(f"{_UNMATCHED}: {t}", f"  {t} (", "):", True) for t in tables]
    for title, kind, yes, no in (
        ("Consent withdrawn", "Consent withdrawn status", "Consent withdrawn", "Consent not withdrawn"),
        ("HIPAA revoked", "HIPAA revoked status", "HIPAA revoked", "HIPAA not revoked"),
        ("Data destruction", "Data destruction status", "Data destruction requested", "Data destruction not requested"),
    ):
        wanted.append((breakdown(kind, "Yes"), f"{yes} (", "):", True))
        wanted.append((breakdown(kind, "No"), f"{no}: ", "", False))
    for status in STUDY_STATUSES:
        verified = status == "Verified"
        wanted.append((breakdown("Study status", status), f"Study status - {status}" + (": " if verified else " ("),
                       "" if verified else "):", not verified))
    wanted.append((_UNDELIVERED, "Eligible participants not in delivery (", "):", True))
    plan = F.broadcast(spark.createDataFrame(
        [(i, w[0].lower(), w[1], w[2], w[3]) for i, w in enumerate(wanted)],
        "line_no int, key string, before string, after string, with_ids boolean"))

    key = F.lower("name").alias("key")
    counts = metrics.select(key, F.col("value_as_number").alias("n"))
    every = counts.filter(F.col("key").startswith(_UNMATCHED.lower())).select(F.lit("*unmatched").alias("key"), "n")
    counts = counts.union(every).groupBy("key").agg(F.sum("n").alias("n"))
    count = F.format_string("%d", F.coalesce("n", F.lit(0)).cast("bigint"))
    heads = plan.join(counts, "key", "left").select(
        "line_no", F.lit(None).cast("string").alias("id"), F.concat("before", count, "after").alias("line"))
    listed = ids.select(key, "id").join(plan.filter("with_ids"), "key").select(
        "line_no", "id", F.concat(F.lit("    "), F.col("id")).alias("line"))
    return heads.unionByName(listed)
