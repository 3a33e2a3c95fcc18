"""A delivery from text tables to harmonized, derived and reported ones."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import __version__, schema
from medloom.functions.keys import mark_unique, unmarked
from medloom.operators import harmonize as h
from medloom.operators import metrics as m
from medloom.operators import participants
from medloom.operators.dedupe import repair_keys
from medloom.operators.normalize import globalize_keys, normalize
from medloom.operators.routing import route_all
from medloom.operators.upgrade import delivered_vocabulary_version, extraction_date, populate_source, upgrade
from medloom.operators.validate import validate
from medloom.operators.vocabulary import Vocabulary
from medloom.plans import report
from medloom.plans.derive import derive
from medloom.plans.tasks import run_task
from medloom.sources import publish


@dataclass(frozen=True)
class Site:
    """How one site delivers."""

    name: str
    delivery_date: dt.date
    version: str = "5.4"
    date_format: str = "%Y-%m-%d"
    datetime_format: str = "%Y-%m-%d %H:%M:%S"
    steps: list[str] = field(default_factory=lambda: list(h.DEFAULT_STEPS))
    # Also fill zero concepts of further pairs; off unless asked for.
    fill_secondary: bool = False
    # Descriptions for cdm_source, should the site send none.
    facts: dict[str, str] = field(default_factory=dict)
    file_format: str = "csv"
    vocabulary_version: str = ""
    # Clean-up tasks in order: name -> {table: SELECT ...}.
    tasks: dict[str, dict[str, str | None]] = field(default_factory=dict)


@dataclass(frozen=True)
class Processed:
    tables: dict[str, DataFrame]
    invalid: dict[str, DataFrame]
    report: DataFrame


def process(
    spark: SparkSession, delivered: dict[str, DataFrame], site: Site, vocabulary: dict[str, DataFrame], root: str,
    registry: DataFrame | None = None, as_of: dt.date | None = None, run_at: dt.datetime | None = None,
    vocabulary_root: str | None = None,
) -> Processed:
    """Run every stage over text tables and write the results under ``root``.

    Tables are written at the end of each stage and read back, so a stage
    starts from files and an executor lost later costs no earlier stage. The
    lookups made from the vocabulary are kept below ``vocabulary_root``, which
    deliveries may share, and made again only when the vocabulary differs.
    """
    as_of = as_of or site.delivery_date
    run_at = run_at or dt.datetime.combine(site.delivery_date, dt.time())
    codes = Vocabulary.prepared(
        vocabulary["concept"], vocabulary["concept_relationship"], vocabulary_root or f"{root}/vocabulary")

    metrics = [validate(spark, delivered, site.version)]
    tables, invalid = {}, {}
    for table, df in delivered.items():
        if table not in schema.tables(site.version):
            continue
        tables[table], invalid[table], counted = _normalized(df, table, site, root)
        metrics.append(report.normalization(counted, table))
    upgraded = {t: upgrade(df, t, site.version, "5.4") for t, df in tables.items()}
    upgraded["cdm_source"] = populate_source(
        upgraded.get("cdm_source"), spark, site.facts, site.delivery_date, "5.4", site.vocabulary_version,
        site.date_format)
    tables = {t: globalize_keys(df, t, site.name) for t, df in upgraded.items() if df is not None}
    if registry is not None:
        metrics.append(report.registry(tables, registry, invalid))
        ids = publish.write_parquet(report.registry_ids(tables, registry, invalid), f"{root}/{publish.REPORT}/registry_ids")
        for table, df in tables.items():
            if "person_id" in df.columns:
                metrics.append(report.removals(participants.removal_counts(df, registry), table))
                tables[table] = participants.eligible_rows(df, registry)

    harmonized = {}
    for table in [t for t in schema.HARMONIZED_TABLES if t in tables]:
        harmonized[table], counted = _harmonized(tables[table], table, site, codes, root)
        metrics += counted
        # What stays in the table comes back with the routed rows.
        del tables[table]
    # Tables that were delivered stay, even if no row is routed to them.
    routed = {t: spark.createDataFrame([], schema.layout(t)) for t in harmonized} | route_all(harmonized, site.name)
    for table, df in routed.items():
        tables[table] = _with_unique_keys(publish.write_parquet(df, f"{root}/{publish.ROUTED}/{table}"), table, root)
    for table in [t for t in tables if t not in schema.HARMONIZED_TABLES]:
        tables[table] = publish.write_parquet(tables[table], f"{root}/{publish.CONVERTED}_final/{table}")
    for name, statements in site.tasks.items():
        tables, counted = _cleaned(tables, name, statements, root)
        metrics.append(counted)
    for name in schema.DERIVED_TABLES:
        derived = derive(name, tables, vocabulary, as_of, site.name)
        if derived is not None:
            tables[name] = publish.write_parquet(derived, f"{root}/{publish.DERIVED}/{name}")

    metrics += [
        m.as_metrics(extraction_date(tables["cdm_source"], site.delivery_date), F.lit("Source system extraction date"),
                     F.col("extraction_date")),
        _delivered_vocabulary(tables, spark),
    ]
    about = report.Delivery(spark, tables, vocabulary["concept"], site.delivery_date, {
        "Site": site.name,
        "File delivery format": site.file_format,
        "Delivered CDM version": site.version,
        "Standardized to CDM version": "5.4",
        "Standardized to vocabulary version": site.vocabulary_version,
        "Pipeline version": __version__,
        "Delivery processing date": run_at.date().isoformat(),
    })
    rows = publish.write_parquet(report.generate(about, metrics, run_at), f"{root}/{publish.REPORT}/rows")
    publish.write_csv(rows, f"{root}/{publish.REPORT}/delivery_report")
    if registry is not None:
        lines = report.study_summary(spark, rows, ids)
        publish.write_lines(lines, ["line_no", "id"], f"{root}/{publish.REPORT}/study_summary")
    return Processed(tables, invalid, rows)


def _normalized(df: DataFrame, table: str, site: Site, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid rows, invalid rows and their counts, from one pass over the table."""
    result = normalize(df, table, site.version, site.date_format, site.datetime_format)
    path = f"{root}/{publish.CONVERTED}/{table}"
    written = publish.write_parquet(result.flagged, path, partition_by=["is_valid"])
    back = type(result)(written.withColumn("is_valid", F.col("is_valid").cast("boolean")), result.columns)
    return back.valid, back.invalid, back.row_counts()


def _with_unique_keys(written: DataFrame, table: str, root: str) -> DataFrame:
    """A routed table, written anew only if keys had to be repaired."""
    if table not in schema.SURROGATE_KEY_TABLES:
        return written
    key = schema.primary_key(table)
    keyed = repair_keys(written, key)
    if keyed is not written:
        written = publish.write_parquet(keyed, f"{root}/{publish.ROUTED}_keyed/{table}")
    return mark_unique(written, key)


def _delivered_vocabulary(tables: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    name = "Delivered vocabulary version"
    if "vocabulary" not in tables:
        return m.metric_frame(spark, [m.Metric(name)])
    return m.as_metrics(delivered_vocabulary_version(tables["vocabulary"]), F.lit(name), F.col("vocabulary_version"))


def _cleaned(
    tables: dict[str, DataFrame], name: str, statements: dict[str, str | None], root: str,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables after a task; those it wrote are written to a place of their own."""
    result = run_task(name, tables, statements)
    written = {
        # What is known of a table's keys no longer holds once a task has written it.
        t: publish.write_parquet(
            unmarked(df, key) if (key := schema.primary_key(t)) in df.columns else df, f"{root}/{publish.CLEANED}/{name}/{t}")
        if t in statements else df
        for t, df in result.tables.items()
    }
    return written, result.metrics()


def _harmonized(
    df: DataFrame, table: str, site: Site, codes: Vocabulary, root: str,
) -> tuple[DataFrame, list[DataFrame]]:
    key = schema.primary_key(table)
    # Delivered keys may repeat; keys made from content repeat only with it.
    repeated = None if table in schema.SURROGATE_KEY_TABLES else key
    rows = h.harmonize(df, table, codes, site.steps, repeated_key=repeated)
    metrics = []
    if site.fill_secondary:
        primary = schema.PRIMARY_CONCEPT[table]
        pairs = [pair for pair in schema.concept_pairs(table) if pair[0] != primary]
        if pairs:
            metrics.append(report.secondary_backfill(h.secondary_backfill_counts(rows, pairs, codes), table))
            rows = h.backfill_secondary(rows, pairs, codes)
    # By target, so that a move reads the rows it moves and no others.
    written = publish.write_parquet(rows, f"{root}/{publish.HARMONIZED}/{table}", partition_by=["target_table"])
    metrics.append(report.harmonization(written, table, key))
    return written, metrics
