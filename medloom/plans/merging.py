"""One instance from the processed deliveries of many sites."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import schema
from medloom.operators import merge
from medloom.operators import metrics as m
from medloom.plans import report
from medloom.sources import publish

# Made for the merged instance rather than taken from the sites.
_BUILT = ["care_site", "cdm_source"]


@dataclass(frozen=True)
class Source:
    """A processed delivery that goes into the merge."""

    site: str
    site_name: str
    delivery_date: dt.date
    tables: dict[str, DataFrame]


@dataclass(frozen=True)
class Merged:
    tables: dict[str, DataFrame]
    report: DataFrame


def merge_deliveries(
    spark: SparkSession, sources: list[Source], root: str, run_date: dt.date, facts: dict[str, str],
    vocabulary_version: str, version: str = "5.4", run_at: dt.datetime | None = None,
) -> Merged:
    """Stage every table by site and delivery, then read the chunks as one table.

    A site can be staged again without touching the others' chunks.
    """
    if not sources:
        raise ValueError("no deliveries to merge")
    named = [t for t in schema.tables(version) if any(t in source.tables for source in sources)]
    staged = {}
    for table in named:
        chunks = []
        for source in [x for x in sources if table in x.tables]:
            chunk = merge.extract_chunk(
                source.tables[table], table, source.site, source.delivery_date, source.site_name)
            publish.write_chunk(chunk, root, table, source.site, source.delivery_date)
            chunks.append((source.site, source.delivery_date))
        staged[table] = publish.read_chunks(spark, root, table, chunks)
    tables = {
        t: publish.write_parquet(merge.reconcile(chunks), f"{root}/{publish.CONVERTED}/{t}")
        for t, chunks in staged.items() if t not in _BUILT
    }
    tables["care_site"] = publish.write_parquet(
        merge.care_sites(spark, [s.site_name for s in sources]), f"{root}/{publish.CONVERTED}/care_site")
    delivered = staged.get("cdm_source", spark.createDataFrame([], schema.layout("cdm_source", version)))
    tables["cdm_source"] = publish.write_parquet(
        merge.merged_source(delivered, facts, len({s.site for s in sources}), version, vocabulary_version, run_date),
        f"{root}/{publish.CONVERTED}/cdm_source")

    counts = m.unite([merge.delivery_counts(chunks) for chunks in staged.values()])
    per_delivery = counts.groupBy(*merge.PROVENANCE).agg(F.sum("row_count").alias("row_count"))
    rows = m.finish_report(report.merge(spark, per_delivery), run_at or dt.datetime.combine(run_date, dt.time()))
    written = publish.write_parquet(rows, f"{root}/{publish.REPORT}/rows")
    publish.write_csv(written, f"{root}/{publish.REPORT}/delivery_report")
    return Merged(tables, written)
