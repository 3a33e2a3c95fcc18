"""Writing tables, reports and publishing to a catalog."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom import schema
from medloom.operators.merge import PROVENANCE, widened
from medloom.operators.normalize import conform
from medloom.operators.participants import decode_status
from medloom.sources.storage import create_once, numbered

logger = logging.getLogger(__name__)

# Folders of a delivery's artifacts.
CONVERTED = "artifacts/converted_files"
HARMONIZED = "artifacts/harmonized_files"
ROUTED = "artifacts/omop_etl"
DERIVED = "artifacts/derived_files"
INVALID = "artifacts/invalid_rows"
REPORT = "artifacts/delivery_report"
REGISTRY = "artifacts/registry"
CHUNKS = "artifacts/merge_chunks"
CLEANED = "artifacts/post_processing"


def folder_of(table: str) -> str:
    """Artifact folder that holds the final form of a table."""
    if table in schema.HARMONIZED_TABLES:
        return ROUTED
    return DERIVED if table in schema.DERIVED_TABLES else CONVERTED


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, compact: bool = False) -> DataFrame:
    """Write a table and return it read back, empty ones included. Spark refuses a path the table reads from.

    ``compact`` is for tables that only Spark reads back: numbers and texts are
    stored as what differs from the value before (pages of version 2), which
    other readers may not know.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if compact:
        # A list of the distinct values would come first, and is as large as the column where most values are distinct.
        writer = writer.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. For reports, whose size the model bounds: counts, no ids.

    The shuffle keeps the work that leads to the report parallel.
    """
    df.repartition(1).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_lines(lines: DataFrame, order: list[str], path: str) -> None:
    """Text files of lines that read in order, file after file. Parallel, as some lines are ids."""
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("line").write.mode("overwrite").text(path)


def export_registry(participants: DataFrame, root: str, site: Column | None = None) -> DataFrame:
    """Write the decoded participant registry of a delivery."""
    return write_parquet(decode_status(participants, site), f"{root}/{REGISTRY}")


def _chunk_path(root: str, table: str, site: str, delivery_date: dt.date) -> str:
    return f"{root}/{CHUNKS}/{table}/site={quote(site, safe='')}/delivery_date={delivery_date.isoformat()}"


def write_chunk(chunk: DataFrame, root: str, table: str, site: str, delivery_date: dt.date) -> None:
    """Stage one site's chunk in a folder of its own; an empty one replaces what was there as well."""
    path = _chunk_path(root, table, site, delivery_date)
    chunk.drop(*PROVENANCE).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_chunks(spark: SparkSession, root: str, table: str, chunks: list[tuple[str, dt.date]]) -> DataFrame:
    """The named chunks of a table and no others.

    A column some lack is NULL there; where sites deliver a column in several
    types, it has the narrowest type that holds them all (``widened``). Chunks
    of one layout are read together.
    """
    layouts: dict[str, tuple[T.StructType, list[tuple[str, dt.date]]]] = {}
    for site, day in chunks:
        found = spark.read.parquet(_chunk_path(root, table, site, day)).schema
        layouts.setdefault(found.json(), (found, []))[1].append((site, day))
    whole = widened([layout for layout, _ in layouts.values()])
    parts = []
    for layout, named in layouts.values():
        # Site names are text even where they look like numbers.
        provenance = [T.StructField("site", T.StringType()), T.StructField("delivery_date", T.DateType())]
        paths = [_chunk_path(root, table, site, day) for site, day in named]
        part = spark.read.schema(T.StructType([*layout, *provenance])).option("basePath", f"{root}/{CHUNKS}/{table}").parquet(*paths)
        parts.append(part.select(
            *[(F.col(f"`{f.name}`") if f.name in layout.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole],
            *[p.name for p in provenance]))
    return reduce(DataFrame.unionByName, parts)


def publish(df: DataFrame | None, table: str, layout: T.StructType | None = None, path: str | None = None) -> bool:
    """Replace a catalog table by a frame; False if there is none.

    The rows are written whole to a folder of their own below ``path`` (by
    default beside the database's tables). Only then the table is pointed
    there, in one step of the catalog, so a write that fails leaves the former
    rows readable, and a reader never sees part of a table. The commit that
    names the folder is kept with its row count (``published_versions``).
    """
    if df is None:
        return False
    spark = df.sparkSession
    rows = conform(df, layout) if layout else df
    base = (path or _versions_folder(spark, table)).rstrip("/")
    folder = f"{base}/v-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    _recover(spark, table)
    _commit(spark, base, folder, written.count())
    if spark.catalog.tableExists(table) and _same_layout(spark.table(table).schema, rows.schema) and _is_parquet(spark, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return True
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    new = table if not spark.catalog.tableExists(table) else f"{table}_conformed"
    spark.sql(f"CREATE TABLE {new} ({columns}) USING parquet LOCATION '{folder}'")
    if new != table:
        _swap(spark, table)
    return True


_COMMIT = "number long, folder string, row_count long"


def _commit(spark: SparkSession, base: str, folder: str, rows: int) -> int:
    """Add a commit with the next number; of several writers each gets one of its own."""
    while True:
        number = len(numbered(spark, f"{base}/commits")) + 1
        if create_once(spark.createDataFrame([(number, folder, rows)], _COMMIT), f"{base}/commits/{number:012d}"):
            return number


def published_versions(spark: SparkSession, table: str, path: str | None = None) -> DataFrame:
    """(number, folder, row_count) of the commits to a table, also of those that have since been replaced."""
    base = (path or _versions_folder(spark, table)).rstrip("/")
    found = [f"{base}/commits/{n}" for n in numbered(spark, f"{base}/commits")]
    return spark.read.schema(_COMMIT).parquet(*found) if found else spark.createDataFrame([], _COMMIT)


def _versions_folder(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/_versions/{name}"


def _same_layout(one: T.StructType, other: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in one] == [(f.name, f.dataType) for f in other]


def _is_parquet(spark: SparkSession, table: str) -> bool:
    """Whether a table can be pointed at a folder: a Parquet table that the catalog does not delete with its folder."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return facts.get("Provider", "").lower() == "parquet" and facts.get("Type") == "EXTERNAL"


def publish_all(delivery: dict[str, DataFrame], database: str, names: list[str] | None = None) -> list[str]:
    """Publish the named tables that exist; returns those published."""
    chosen = names if names is not None else list(delivery)
    return [t for t in chosen if publish(delivery.get(t), f"{database}.{t}", schema.tables().get(t))]


def publish_harmonized(delivery: dict[str, DataFrame], database: str) -> list[str]:
    return publish_all(delivery, database, schema.HARMONIZED_TABLES)


def publish_derived(delivery: dict[str, DataFrame], database: str) -> list[str]:
    return publish_all(delivery, database, list(schema.DERIVED_TABLES))


def create_missing(spark: SparkSession, database: str, version: str = "5.4") -> list[str]:
    """Bring a database to the model: conform what exists, create what lacks."""
    made = []
    for table, layout in schema.tables(version).items():
        name = f"{database}.{table}"
        _recover(spark, name)
        if not spark.catalog.tableExists(name):
            spark.createDataFrame([], layout).write.format("parquet").saveAsTable(name)
            made.append(table)
            continue
        existing = spark.table(name)
        if [(f.name, f.dataType) for f in existing.schema] != [(f.name, f.dataType) for f in layout]:
            conform(existing, layout).write.mode("overwrite").format("parquet").saveAsTable(f"{name}_conformed")
            _swap(spark, name)
    return made


def _swap(spark: SparkSession, name: str) -> None:
    """Put the conformed table in place by renaming; the former one goes last."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}_former")
    spark.sql(f"ALTER TABLE {name}_conformed RENAME TO {name}")
    spark.sql(f"DROP TABLE {name}_former")


def _recover(spark: SparkSession, name: str) -> None:
    """Finish a swap that was cut off: at every moment the rows are in a whole table."""
    if spark.catalog.tableExists(f"{name}_former"):
        if not spark.catalog.tableExists(name):
            # Both new and former are whole; the new one is complete once the former was renamed.
            spark.sql(f"ALTER TABLE {name}_conformed RENAME TO {name}")
        spark.sql(f"DROP TABLE {name}_former")
    elif spark.catalog.tableExists(f"{name}_conformed"):
        spark.sql(f"DROP TABLE {name}_conformed")
