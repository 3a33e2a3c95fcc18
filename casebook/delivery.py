"""Reading, normalizing, upgrading and keying a delivery."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.people import CHECKS as CHECKS_OF_PEOPLE
from casebook.sql import SITE, key
from casebook.views import Views, with_views
from medloom import schema
from medloom.functions.casts import as_date, as_double, as_long, as_timestamp
from medloom.operators.metrics import finish_report
from medloom.operators.normalize import conform, globalize_keys, normalize
from medloom.operators.upgrade import (
    delivered_vocabulary_version, extraction_date, populate_source, standardized_versions, upgrade,
)
from medloom.operators.validate import validate
from medloom.plans.pipeline import Site, _normalized
from medloom.plans.report import normalization
from medloom.sources import ingest, storage
from medloom.sources.publish import (
    create_missing, export_registry, publish, publish_all, publish_derived, publish_harmonized, published_versions, write_csv,
    write_parquet,
)

QUERIES, CHECKS = {}, {}

# ---- text clean-up ----

QUERIES["string_nulls"] = lambda v: ingest.null_words(v["f_raw_drug"])
CHECKS["string_nulls"] = with_views(
    "SELECT person_id, nullif(nullif(drug_concept_id, 'NULL'), 'null') AS drug_concept_id, drug_exposure_start_date,"
    " quantity, not_in_schema FROM f_raw_drug")

_ODD_NAMES = {"person_id": "Person ID!", "drug_concept_id": " Drug_Concept_Id", "quantity": "QUANTITY (mg)"}
QUERIES["clean_names"] = lambda v: ingest.clean_names(
    v["f_raw_drug"].withColumnsRenamed(_ODD_NAMES).select(*_ODD_NAMES.values()))
CHECKS["clean_names"] = with_views(
    "SELECT person_id AS personid, drug_concept_id, quantity AS quantitymg FROM f_raw_drug")

QUERIES["parquet_as_text"] = lambda v: ingest.read_parquet(v.spark, f"{v.sf_dir}/orders.parquet").select(
    "o_orderkey", "o_custkey", "o_orderstatus", F.substring("o_orderdate", 1, 10).alias("o_day"))
CHECKS["parquet_as_text"] = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS o_day FROM orders"""

# Lines of a delivered file: some short, some with a value too many, some with an open quote.
# Lines of other widths, a quote that never closes, and records over three lines, the middle one like a record by itself.
_LINES = """
SELECT CASE WHEN l_partkey % 23 = 0 THEN concat(CAST(l_orderkey AS STRING), ',', CAST(l_linenumber AS STRING))
            WHEN l_partkey % 19 = 0 THEN concat(CAST(l_orderkey AS STRING), ',1,a,b')
            WHEN l_partkey % 17 = 0 THEN concat(CAST(l_orderkey AS STRING), ',"open,1')
            WHEN l_partkey % 13 = 0 THEN concat(CAST(l_orderkey AS STRING), ',"x', chr(10), CAST(l_orderkey AS STRING), ',2,y', chr(10), 'z",', repeat('"', 2))
            WHEN l_partkey % 11 = 0 THEN concat(CAST(l_orderkey AS STRING), ',5" tall,', repeat('"', 4))
            ELSE concat(CAST(l_orderkey AS STRING), ',', CAST(l_linenumber AS STRING), ',"', l_returnflag, ' ""q"" x"') END AS line
FROM lineitem"""


def _read_lines(v: Views) -> tuple[DataFrame, DataFrame]:
    path = storage.scratch_path(v.spark, "lines")
    v.sql(_LINES).write.text(path)
    return ingest.read_csv(v.spark, path, names=["l_orderkey", "l_linenumber", "remark"])


QUERIES["csv_records"] = lambda v: _read_lines(v)[0]
CHECKS["csv_records"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
       CASE WHEN l_partkey % 23 = 0 THEN CAST(l_linenumber AS VARCHAR)
            WHEN l_partkey % 13 = 0 THEN concat('x', chr(10), l_orderkey, ',2,y', chr(10), 'z')
            WHEN l_partkey % 11 = 0 THEN '5" tall' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
       CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 11 = 0 THEN '"'
            ELSE l_returnflag || ' "q" x' END AS remark
FROM lineitem WHERE l_partkey % 23 = 0 OR (l_partkey % 19 <> 0 AND l_partkey % 17 <> 0)"""
QUERIES["csv_rejects"] = lambda v: _read_lines(v)[1]
CHECKS["csv_rejects"] = """
SELECT CASE WHEN l_partkey % 19 = 0 THEN concat(l_orderkey, ',1,a,b') ELSE concat(l_orderkey, ',"open,1') END AS line,
       CASE WHEN l_partkey % 19 = 0 THEN 'too many values' ELSE 'open quote' END AS reason
FROM lineitem WHERE l_partkey % 23 <> 0 AND (l_partkey % 19 = 0 OR l_partkey % 17 = 0)"""

# Files with a header each, also one with a line break, and rows that look like it; as written by Spark.
_NOTES = """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'order_id' ELSE CAST(o_orderkey AS {t}) END AS order_id,
       CASE WHEN o_orderkey % 7 = 0 THEN concat('note', chr(10), 'text') WHEN o_orderkey % 3 = 0 THEN
            concat('"', o_orderpriority, '",', chr(10), CAST(o_orderkey AS {t}), ',x,y', chr(13), chr(10), chr(10), 'end ', CAST(o_custkey AS {t}))
            ELSE o_orderstatus END AS {note}, o_orderpriority FROM orders"""


def _read_notes(v: Views) -> DataFrame:
    path = storage.scratch_path(v.spark, "notes")
    text = v.sql(_NOTES.format(t="STRING", note="note")).withColumnRenamed("note", "note\ntext")
    text.write.options(header=True, escape='"').csv(path)
    return ingest.read_csv(v.spark, path)[0]


QUERIES["csv_files"] = _read_notes
CHECKS["csv_files"] = _NOTES.format(t="VARCHAR", note="notetext")

# Files in several encodings, found from their bytes; one table of a folder for each.
_ENCODINGS = ["UTF-8", "UTF-16LE", "UTF-16BE", "ISO-8859-1"]


def _read_encodings(v: Views) -> DataFrame:
    parts = []
    for i, name in enumerate(_ENCODINGS):
        path = storage.scratch_path(v.spark, "encoded")
        rows = v["customer"].filter(F.col("c_custkey") % 4 == i).selectExpr(
            "c_custkey", "concat(c_name, ' d\u00e9j\u00e0', CASE WHEN c_custkey % 3 = 0 THEN chr(10) ELSE '' END) AS c_name")
        rows.write.options(header=True, escape='"', encoding=name, ignoreTrailingWhiteSpace=False).csv(path)
        parts.append(ingest.read_csv(v.spark, path)[0])
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


QUERIES["csv_encodings"] = _read_encodings
CHECKS["csv_encodings"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_name || ' d\u00e9j\u00e0' || CASE WHEN c_custkey % 3 = 0 THEN chr(10) ELSE '' END AS c_name FROM customer"""

# ---- normalization ----


def _drugs(v: Views):
    text = Views(v.spark, v.sf_dir, spread=True)["f_raw_drug"]
    return normalize(ingest.null_words(text), "drug_exposure", date_format="%m/%d/%Y")


_TYPED = ("typed", """
    SELECT *, try_cast(coalesce(person_id, '-1') AS BIGINT) AS person,
           try_cast(coalesce(nullif(drug_concept_id, 'NULL'), '0') AS BIGINT) AS concept,
           coalesce(CAST(try_strptime(drug_exposure_start_date, '%m/%d/%Y') AS DATE),
                    try_cast(drug_exposure_start_date AS DATE), DATE '1970-01-01') AS started
    FROM f_raw_drug""")


def _normalized_sql() -> str:
    given = {"person_id": "person", "drug_concept_id": "concept", "drug_exposure_start_date": "started",
             "drug_exposure_end_date": "DATE '1970-01-01'", "quantity": "CAST(quantity AS DOUBLE)"}
    kinds = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE"}
    layout = schema.layout("drug_exposure")
    values = {
        f.name: f"CAST({given.get(f.name, '0' if f.name.endswith('_concept_id') else 'NULL')}"
                f" AS {kinds[f.dataType.simpleString()]})" for f in layout
    }
    values["drug_exposure_id"] = key([value for name, value in values.items() if name != "drug_exposure_id"])
    return "SELECT " + ", ".join(f"{value} AS {name}" for name, value in values.items()) + " FROM typed"


QUERIES["normalize_valid"] = lambda v: _drugs(v).valid
CHECKS["normalize_valid"] = with_views(_normalized_sql() + " WHERE person IS NOT NULL", _TYPED)
QUERIES["normalize_invalid"] = lambda v: _drugs(v).invalid
CHECKS["normalize_invalid"] = with_views(
    "SELECT person_id, nullif(drug_concept_id, 'NULL') AS drug_concept_id, drug_exposure_start_date, quantity,"
    " not_in_schema FROM typed WHERE person IS NULL", _TYPED)
QUERIES["normalize_row_counts"] = lambda v: _drugs(v).row_counts()
CHECKS["normalize_row_counts"] = with_views(
    "SELECT person IS NOT NULL AS is_valid, count(*) AS row_count FROM typed GROUP BY 1", _TYPED)

# The study's own id column takes the place of person_id; some ids are missing or unreadable.
QUERIES["study_id"] = lambda v: normalize(
    v["f_raw_drug"].withColumnRenamed("person_id", "Site_Connect_ID"), "death").flagged.groupBy(
    "person_id", "is_valid").agg(F.count(F.lit(1)).alias("row_count"))
CHECKS["study_id"] = with_views(
    "SELECT person AS person_id, person IS NOT NULL AS is_valid, count(*) AS row_count FROM typed GROUP BY 1, 2", _TYPED)

QUERIES["birth_datetime"] = lambda v: normalize(v["f_raw_person"], "person").valid.select(
    "person_id", "year_of_birth", "birth_datetime", "gender_concept_id")
CHECKS["birth_datetime"] = with_views(
    """SELECT CAST(person_id AS BIGINT) AS person_id, coalesce(CAST(year_of_birth AS BIGINT), -1) AS year_of_birth,
              coalesce(try_strptime(birth_datetime, '%Y-%m-%d %H:%M:%S'), try_cast(birth_datetime AS TIMESTAMP),
                       try_cast(concat(coalesce(year_of_birth, '1900'), '-', lpad(coalesce(month_of_birth, '1'), 2, '0'),
                                       '-', lpad(coalesce(day_of_birth, '1'), 2, '0')) AS TIMESTAMP)) AS birth_datetime,
              CAST(0 AS BIGINT) AS gender_concept_id FROM f_raw_person""")

# Text that is hard to read as a number or a date, by the rows of a table.
_ODD_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN '12.7' WHEN 1 THEN '-12.5' WHEN 2 THEN '1e3' WHEN 3 THEN '.5'
            WHEN 4 THEN ' 12 ' WHEN 5 THEN '5d' WHEN 6 THEN '' WHEN 7 THEN '9223372036854775808' WHEN 8 THEN 'x1'
            WHEN 9 THEN '1.5e0' WHEN 10 THEN '+7' ELSE CAST(o_custkey AS STRING) END AS number_text,
       CASE o_orderkey % 10 WHEN 0 THEN '2024' WHEN 1 THEN '2024-01' WHEN 2 THEN '2024/01/05' WHEN 3 THEN '2024-1-5'
            WHEN 4 THEN '2024-01-05 10:11:12' WHEN 5 THEN '2024-13-01' WHEN 6 THEN '2024-01-05 25:00:00'
            WHEN 7 THEN '01/05/2024' WHEN 8 THEN '2024-01-05T10:11' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS date_text
FROM orders"""


def _lenient(v: Views) -> DataFrame:
    number, date = F.col("number_text"), F.col("date_text")
    return v.sql(_ODD_TEXT).select(
        "o_orderkey", as_long(number).alias("as_long"), as_double(number).alias("as_double"),
        as_date(date).alias("as_date"), as_timestamp(date).alias("as_timestamp"))


QUERIES["lenient_casts"] = _lenient
CHECKS["lenient_casts"] = f"""
SELECT o_orderkey, try_cast(number_text AS BIGINT) AS as_long, try_cast(number_text AS DOUBLE) AS as_double,
       try_cast(date_text AS DATE) AS as_date,
       try_cast(date_text AS TIMESTAMP) AS as_timestamp FROM ({_ODD_TEXT})"""

# ---- names, keys, versions ----

QUERIES["natural_keys"] = lambda v: globalize_keys(v["f_person"], "person", SITE)
CHECKS["natural_keys"] = with_views(
    f"SELECT * REPLACE (CASE WHEN location_id IS NULL THEN NULL ELSE {key(['location_id'], SITE)} END AS location_id,"
    f" CASE WHEN provider_id IS NULL THEN NULL ELSE {key(['provider_id'], SITE)} END AS provider_id) FROM f_person")


def _old_table(v: Views, table: str, values: dict[str, str], source: str) -> DataFrame:
    """A 5.3 table made of a given one; columns not listed are NULL."""
    layout = schema.layout(table, "5.3")
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP_NTZ",
             "string": "STRING"}
    return v.sql("SELECT " + ", ".join(
        f"CAST({values.get(f.name, 'NULL')} AS {kinds[f.dataType.simpleString()]}) AS {f.name}" for f in layout
    ) + f" FROM {source}")


# Fixed values of the model: columns that version 5.4 renamed.
_RENAMED = {
    "visit_occurrence": {
        "admitting_source_concept_id": "admitted_from_concept_id",
        "admitting_source_value": "admitted_from_source_value",
        "discharge_to_concept_id": "discharged_to_concept_id",
        "discharge_to_source_value": "discharged_to_source_value",
    },
    "visit_detail": {
        "admitting_source_value": "admitted_from_source_value",
        "admitting_source_concept_id": "admitted_from_concept_id",
        "discharge_to_source_value": "discharged_to_source_value",
        "discharge_to_concept_id": "discharged_to_concept_id",
        "visit_detail_parent_id": "parent_visit_detail_id",
    },
}


def _new_table(table: str, values: dict[str, str], source: str) -> str:
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "string": "VARCHAR"}
    renamed = _RENAMED.get(table, {})
    moved = {renamed.get(name, name): value for name, value in values.items()}
    if table == "cdm_source":
        moved["cdm_version_concept_id"] = "756265"
    return "SELECT " + ", ".join(
        f"CAST({moved.get(f.name, 'NULL')} AS {kinds[f.dataType.simpleString()]}) AS {f.name}"
        for f in schema.layout(table)
    ) + f" FROM {source}"


# Some columns of each table that the upgrade changes, taken from the given tables.
_UPGRADES = {
    "visit_occurrence": ({"visit_occurrence_id": "o_orderkey", "person_id": "o_custkey",
                          "admitting_source_concept_id": "o_orderkey % 7", "admitting_source_value": "o_orderstatus",
                          "discharge_to_concept_id": "o_orderkey % 5", "discharge_to_source_value": "o_orderpriority",
                          "visit_start_date": "o_orderdate"}, "orders"),
    "visit_detail": ({"visit_detail_id": "o_orderkey", "admitting_source_value": "o_orderstatus",
                      "admitting_source_concept_id": "o_orderkey % 7", "discharge_to_source_value": "o_orderpriority",
                      "discharge_to_concept_id": "o_orderkey % 5", "visit_detail_parent_id": "o_orderkey - 1"},
                     "orders"),
    "procedure_occurrence": ({"procedure_occurrence_id": "o_orderkey", "procedure_date": "o_orderdate",
                              "quantity": "o_custkey", "modifier_source_value": "o_orderstatus"}, "orders"),
    "device_exposure": ({"device_exposure_id": "o_orderkey", "unique_device_id": "o_orderpriority",
                         "device_source_concept_id": "o_custkey"}, "orders"),
    "measurement": ({"measurement_id": "o_orderkey", "value_as_number": "o_totalprice",
                     "value_source_value": "o_orderstatus"}, "orders"),
    "observation": ({"observation_id": "o_orderkey", "value_as_string": "o_orderpriority",
                     "qualifier_source_value": "o_orderstatus"}, "orders"),
    "note": ({"note_id": "doc_id", "note_text": "text", "note_source_value": "source"}, "documents"),
    "location": ({"location_id": "c_custkey", "address_1": "c_name", "state": "c_mktsegment"}, "customer"),
    "metadata": ({"metadata_concept_id": "p_partkey", "name": "p_name", "value_as_string": "p_brand"}, "part"),
    "cdm_source": ({"cdm_source_name": "s_name", "cdm_version": "'v5.3'", "cdm_holder": "s_nationkey"}, "supplier"),
}
for _table, (_values, _source) in _UPGRADES.items():
    QUERIES[f"upgrade_{_table}"] = lambda v, t=_table, a=_values, s=_source: upgrade(
        _old_table(v, t, a, s), t, "5.3", "5.4")
    CHECKS[f"upgrade_{_table}"] = _new_table(_table, _values, _source)

_DELIVERY = dt.date(2002, 1, 1)
_FACTS = {"cdm_source_name": "Site A records", "cdm_source_abbreviation": "A", "cdm_holder": "Site A",
          "source_description": "records", "source_release_date": "12/31/2001"}


def _delivered_source(v: Views) -> DataFrame:
    """One delivered row made of all orders: the newest date and the number of orders."""
    return v["orders"].agg(
        F.lit("delivered").alias("cdm_source_name"), F.lit("D").alias("cdm_source_abbreviation"),
        F.count(F.lit(1)).cast("string").alias("source_description"),
        F.date_format(F.max("o_orderdate"), "MM/dd/yyyy").alias("source_release_date"),
        F.lit("not known").alias("cdm_release_date"), F.lit("v5.3").alias("cdm_version"),
    )


def _one_source(v: Views) -> DataFrame:
    return populate_source(_delivered_source(v), v.spark, _FACTS, _DELIVERY, "5.4", "v5.0 29-FEB-24", "%m/%d/%Y")


_ONE_SOURCE = """SELECT 'delivered' AS cdm_source_name, 'D' AS cdm_source_abbreviation, CAST(NULL AS VARCHAR) AS cdm_holder,
    CAST(count(*) AS VARCHAR) AS source_description, CAST(NULL AS VARCHAR) AS source_documentation_reference,
    CAST(NULL AS VARCHAR) AS cdm_etl_reference, CAST(max(o_orderdate) AS DATE) AS source_release_date,
    DATE '2002-01-01' AS cdm_release_date, '5.4' AS cdm_version, CAST(756265 AS BIGINT) AS cdm_version_concept_id,
    'v5.0 29-FEB-24' AS vocabulary_version FROM orders"""
QUERIES["cdm_source_delivered"] = _one_source
CHECKS["cdm_source_delivered"] = _ONE_SOURCE
QUERIES["extraction_date"] = lambda v: extraction_date(_delivered_source(v), _DELIVERY, "%m/%d/%Y")
CHECKS["extraction_date"] = "SELECT CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS extraction_date FROM orders"
QUERIES["standardized_versions"] = lambda v: standardized_versions(_one_source(v))
CHECKS["standardized_versions"] = f"SELECT cdm_version, vocabulary_version FROM ({_ONE_SOURCE})"
_RELEASES = """SELECT CASE WHEN p_partkey = 3 THEN 'None' ELSE p_brand END AS vocabulary_id,
                      concat('v', CAST(p_partkey AS STRING)) AS vocabulary_version FROM part"""
QUERIES["delivered_vocabulary_version"] = lambda v: delivered_vocabulary_version(v.sql(_RELEASES))
CHECKS["delivered_vocabulary_version"] = f"SELECT vocabulary_version FROM ({_RELEASES}) WHERE vocabulary_id = 'None'"

# ---- sinks ----


def _published(v: Views) -> DataFrame:
    """Written in the model's layout and read back."""
    rows = conform(v["f_visit"], schema.layout("visit_occurrence"))
    back = write_parquet(rows, storage.scratch_path(v.spark, "visits"))
    return back.select("visit_occurrence_id", "person_id", "visit_start_date", "visit_end_date", "provider_id")


QUERIES["publish_roundtrip"] = _published
CHECKS["publish_roundtrip"] = with_views(
    "SELECT visit_occurrence_id, person_id, visit_start_date, visit_end_date, CAST(NULL AS BIGINT) AS provider_id"
    " FROM f_visit")


def _vocabulary_file(v: Views) -> DataFrame:
    """Concepts written as a tab-separated file and read back typed."""
    path = storage.scratch_path(v.spark, "concepts")
    v.sql("""SELECT p_partkey AS concept_id, concat('a "', p_name) AS concept_name, 'Drug' AS domain_id,
                    p_brand AS vocabulary_id, '20200131' AS valid_start_date FROM part""").write.options(
        sep="\t", header=True, quote="").csv(path)
    return ingest.read_vocabulary(v.spark, path, "concept").select(
        "concept_id", "concept_name", "vocabulary_id", "valid_start_date", "valid_end_date")


QUERIES["vocabulary_file"] = _vocabulary_file
CHECKS["vocabulary_file"] = """SELECT p_partkey AS concept_id, concat('a "', p_name) AS concept_name,
    p_brand AS vocabulary_id, DATE '2020-01-31' AS valid_start_date, CAST(NULL AS DATE) AS valid_end_date FROM part"""


def _table(v: Views) -> DataFrame:
    """Published to the catalog, replaced by a second version, and read by name."""
    name = f"published_{uuid.uuid4().hex}"
    for df in (v["f_visit"].limit(1), v["f_visit"]):
        publish(df, name, schema.layout("visit_occurrence"), storage.scratch_path(v.spark, name))
    return v.spark.table(name).select("visit_occurrence_id", "person_id", "visit_start_date", "visit_end_date", "provider_id")


QUERIES["publish_table"] = _table
CHECKS["publish_table"] = CHECKS["publish_roundtrip"]



def _database(v: Views, name: str) -> str:
    """A database of its own in the shared folder."""
    database = f"{name}_{uuid.uuid4().hex}"
    v.spark.sql(f"CREATE DATABASE {database} LOCATION '{storage.scratch_path(v.spark, name)}'")
    return database


def _sets(v: Views) -> DataFrame:
    """All tables of a delivery published by class, twice, into a database; what each name then holds."""
    database = _database(v, "sets")
    delivery = {"visit_occurrence": v["f_visit"], "person": v["f_person"], "death": v["f_death"],
                "observation_period": v["f_visit"].select(
                    F.col("visit_occurrence_id").alias("observation_period_id"), "person_id",
                    F.col("visit_start_date").alias("observation_period_start_date"))}
    for days in (1, 0):
        shown = {t: df.limit(1) if days else df for t, df in delivery.items()}
        names = publish_harmonized(shown, database) + publish_derived(shown, database) + publish_all(
            shown, database, ["person", "death", "note"])
    versions = {t: published_versions(v.spark, f"{database}.{t}").count() for t in names}
    return reduce(DataFrame.unionByName, [
        v.spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("row_count"), F.sum("person_id").alias("people")).select(
            F.lit(t).alias("table_name"), F.lit(versions[t]).cast("bigint").alias("versions"), "row_count", "people") for t in names])


QUERIES["publish_sets"] = _sets
CHECKS["publish_sets"] = with_views("""
SELECT 'visit_occurrence' AS table_name, CAST(2 AS BIGINT) AS versions, count(*) AS row_count, CAST(sum(person_id) AS BIGINT) AS people FROM f_visit
UNION ALL SELECT 'observation_period', 2, count(*), CAST(sum(person_id) AS BIGINT) FROM f_visit
UNION ALL SELECT 'person', 2, count(*), CAST(sum(person_id) AS BIGINT) FROM f_person
UNION ALL SELECT 'death', 2, count(*), CAST(sum(person_id) AS BIGINT) FROM f_death""")


def _conformed(v: Views) -> DataFrame:
    """A database with a table of text in another order: the model's tables appear, its rows come back typed."""
    database = _database(v, "model")
    loose = v["f_death"].select(F.col("death_date").cast("string").alias("death_date"), F.lit("x").alias("odd"), "person_id")
    loose.write.format("parquet").saveAsTable(f"{database}.death")
    made = create_missing(v.spark, database)
    # Of the tables made, the first by name counts them all.
    return v.spark.table(f"{database}.death").select(
        "person_id", "death_date", "death_type_concept_id", F.lit(len(made)).cast("bigint").alias("tables_made"))


QUERIES["conform_table"] = _conformed
CHECKS["conform_table"] = with_views(
    f"SELECT person_id, death_date, CAST(NULL AS BIGINT) AS death_type_concept_id, CAST({len(schema.tables()) - 1} AS BIGINT) AS tables_made FROM f_death")


def _report_file(v: Views) -> DataFrame:
    """Counts written as a report in one file and read back from it."""
    path = storage.scratch_path(v.spark, "report")
    rows = v["orders"].groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit('Priority "'), "o_orderpriority", F.lit('", rows')).alias("name"), "n")
    write_csv(rows, path)
    parts = v.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).count()
    return ingest.read_csv(v.spark, path)[0].withColumn("files", F.lit(parts).cast("bigint"))


QUERIES["report_file"] = _report_file
CHECKS["report_file"] = """
SELECT 'Priority "' || o_orderpriority || '", rows' AS name, CAST(count(*) AS VARCHAR) AS n, CAST(1 AS BIGINT) AS files FROM orders GROUP BY 1"""

QUERIES["registry_export"] = lambda v: export_registry(v["f_participants"], storage.scratch_path(v.spark, "registry"))
CHECKS["registry_export"] = CHECKS_OF_PEOPLE["status_decode"]

# A delivery with a table the model does not know, a column too many and columns missing.
QUERIES["name_checks"] = lambda v: finish_report(validate(
    v.spark, {"death": v["f_death"].withColumn("odd", F.lit(1)), "deaths": v["f_death"]}), dt.datetime(2002, 1, 1)).drop("metadata_id")
CHECKS["name_checks"] = """
SELECT CAST(0 AS INTEGER) AS metadata_concept_id, CAST(32880 AS INTEGER) AS metadata_type_concept_id, name, lower(split_part(name, ':', 1)) AS value_as_string,
       CAST(0 AS INTEGER) AS value_as_concept_id, CAST(NULL AS DOUBLE) AS value_as_number, DATE '2002-01-01' AS metadata_date,
       TIMESTAMP '2002-01-01 00:00:00' AS metadata_datetime
FROM (VALUES ('Valid table name: death'), ('Valid column name: death.death_date'), ('Valid column name: death.person_id'),
             ('Invalid column name: death.odd'), ('Missing column: death.cause_concept_id'),
             ('Missing column: death.cause_source_concept_id'), ('Missing column: death.cause_source_value'),
             ('Missing column: death.death_datetime'), ('Missing column: death.death_type_concept_id'),
             ('Invalid table name: deaths')) t(name)"""


def _nobody(v: Views) -> DataFrame:
    """A table of which no row was delivered goes through the pipeline's normalization."""
    rows = v["f_raw_drug"].filter("person_id = 'nobody'")
    root = storage.scratch_path(v.spark, "delivery")
    counted = _normalized(rows, "drug_exposure", Site("site", _DELIVERY), root)[2]
    return finish_report(normalization(counted, "drug_exposure"), dt.datetime(2002, 1, 1)).select(
        "metadata_concept_id", "name", "value_as_string", "value_as_concept_id", "value_as_number")


QUERIES["normalize_empty"] = _nobody
CHECKS["normalize_empty"] = with_views("""
    SELECT CAST(0 AS INTEGER) AS metadata_concept_id, concat(side, ' row count: drug_exposure') AS name, CAST(NULL AS VARCHAR) AS value_as_string,
           CAST(0 AS INTEGER) AS value_as_concept_id, CAST((SELECT count(*) FROM f_raw_drug WHERE person_id = 'nobody') AS DOUBLE) AS value_as_number
    FROM (VALUES ('Valid'), ('Invalid')) t(side)""")
