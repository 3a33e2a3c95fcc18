"""Many sites into one, and the run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from casebook.views import Views, with_views
from medloom.operators import merge, metrics, runlog
from medloom.plans import report
from medloom.sources import publish, storage

QUERIES, CHECKS = {}, {}

_DAY = dt.date(2024, 5, 1)
_PEOPLE = """SELECT c_custkey AS person_id, c_nationkey AS nation, CAST(999 AS BIGINT) AS care_site_id,
    CAST(1930 + c_custkey % 70 AS BIGINT) AS year_of_birth FROM customer"""


def _chunks(v: Views):
    """Three sites by nation; only one of them sends the year of birth."""
    people = v.sql(_PEOPLE)
    parts = [people.filter(F.col("nation") % 3 == i).drop("nation") for i in range(3)]
    parts[1:] = [df.drop("year_of_birth") for df in parts[1:]]
    return merge.unite_chunks([
        merge.extract_chunk(df, "person", f"site{i}", _DAY + dt.timedelta(i), f"Site {i}") for i, df in enumerate(parts)
    ])


def _site_id(name: str) -> str:
    hexed = f"sha256({name})"
    return (f"CAST('0x' || translate(substr({hexed}, 1, 1), '89abcdef', '01234567') || substr({hexed}, 2, 15) AS BIGINT)")


_CHUNKS = ("chunks", f"""
    SELECT person_id, CASE WHEN nation % 3 = 0 THEN year_of_birth END AS year_of_birth,
           {_site_id("concat('Site ', nation % 3)")} AS care_site_id, concat('site', nation % 3) AS site,
           DATE '2024-05-01' + CAST(nation % 3 AS INTEGER) AS delivery_date
    FROM ({_PEOPLE})""")

QUERIES["merge_chunks"] = _chunks
CHECKS["merge_chunks"] = with_views("SELECT * FROM chunks", _CHUNKS)


def _staged(v: Views):
    """The same sites written and read back, beside a site that sent nobody and one that is not part of the merge."""
    root = storage.scratch_path(v.spark, "merge")
    people = v.sql(_PEOPLE)
    named = []
    for i, name in enumerate(["site0", "site1", "site2", "empty", "foreign"]):
        df = people.filter(F.col("nation") % 3 == i if i < 3 else F.col("nation") == (-1 if i == 3 else 2)).drop("nation")
        df = df if i == 0 else df.drop("year_of_birth")
        chunk = merge.extract_chunk(df, "person", name, _DAY + dt.timedelta(i), f"Site {i}")
        publish.write_chunk(chunk, root, "person", name, _DAY + dt.timedelta(i))
        if name != "foreign":
            named.append((name, _DAY + dt.timedelta(i)))
    return publish.read_chunks(v.spark, root, "person", named)


QUERIES["merge_staged"] = _staged
CHECKS["merge_staged"] = with_views("SELECT * FROM chunks", _CHUNKS)


def _widened(v: Views):
    """One column as whole number, number and text, a day as date and moment: united as by name."""
    root = storage.scratch_path(v.spark, "widened")
    named = []
    kinds = [("bigint", "date"), ("double", "timestamp_ntz"), ("int", "date"), ("string", "date")]
    for i, (amount, day) in enumerate(kinds):
        df = v["orders"].filter(F.col("o_orderkey") % 4 == i).select(
            "o_orderkey", F.col("o_custkey").cast(amount).alias("amount"), F.col("o_custkey").cast("int" if i % 2 else "double").alias("share"),
            F.to_date("o_orderdate").cast(day).alias("day"))
        publish.write_chunk(df if i else df.drop("share"), root, "note", f"site{i}", _DAY)
        named.append((f"site{i}", _DAY))
    numbers = publish.read_chunks(v.spark, root, "note", named[:3]).select(
        "o_orderkey", F.col("amount").cast("string").alias("amount"), "share", "day", "site")
    texts = publish.read_chunks(v.spark, root, "note", [named[0], named[3]]).select("o_orderkey", "amount", "share", "day", "site")
    return numbers.unionByName(texts.withColumn("day", F.col("day").cast("timestamp_ntz")))


QUERIES["merge_types"] = _widened
CHECKS["merge_types"] = """
SELECT o_orderkey, CAST(CAST(o_custkey AS DOUBLE) AS VARCHAR) AS amount,
       CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey AS DOUBLE) END AS share,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, concat('site', o_orderkey % 4) AS site FROM orders WHERE o_orderkey % 4 < 3
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey AS DOUBLE) END,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), concat('site', o_orderkey % 4) FROM orders WHERE o_orderkey % 4 IN (0, 3)"""
QUERIES["merge_report"] = lambda v: metrics.finish_report(
    report.merge(v.spark, merge.delivery_counts(_chunks(v))), dt.datetime(2024, 5, 4, 9)).drop("metadata_id")
CHECKS["merge_report"] = with_views("""
    SELECT CAST(0 AS INTEGER) AS metadata_concept_id, CAST(32880 AS INTEGER) AS metadata_type_concept_id, name, value_as_string,
           CAST(0 AS INTEGER) AS value_as_concept_id, CAST(n AS DOUBLE) AS value_as_number, DATE '2024-05-04' AS metadata_date,
           TIMESTAMP '2024-05-04 09:00:00' AS metadata_datetime
    FROM (SELECT DISTINCT 'Merge source site' AS name, site AS value_as_string, NULL AS n FROM chunks
          UNION ALL SELECT 'Merge source delivery row count', concat(site, '__', delivery_date), count(*) FROM chunks GROUP BY site, delivery_date
          UNION ALL SELECT 'Merge total row count', NULL, count(*) FROM chunks)""", _CHUNKS)
QUERIES["merge_reconcile"] = lambda v: merge.reconcile(_chunks(v))
CHECKS["merge_reconcile"] = with_views("SELECT person_id, year_of_birth, care_site_id FROM chunks", _CHUNKS)
QUERIES["merge_counts"] = lambda v: merge.delivery_counts(_chunks(v))
CHECKS["merge_counts"] = with_views(
    "SELECT site, delivery_date, count(*) AS row_count FROM chunks GROUP BY 1, 2", _CHUNKS)

QUERIES["care_site"] = lambda v: merge.care_sites(v.spark, v["supplier"].select("s_name"))
CHECKS["care_site"] = f"""
SELECT DISTINCT {_site_id('s_name')} AS care_site_id, s_name AS care_site_name,
       CAST(NULL AS BIGINT) AS place_of_service_concept_id, CAST(NULL AS BIGINT) AS location_id,
       CAST(NULL AS VARCHAR) AS care_site_source_value, CAST(NULL AS VARCHAR) AS place_of_service_source_value
FROM supplier"""

_MERGED = {"cdm_source_name": "Merged records", "cdm_source_abbreviation": "MR", "cdm_holder": "Coordinating center",
           "source_description": "Records of {site_count} sites", "source_documentation_reference": "",
           "cdm_etl_reference": ""}
QUERIES["merged_cdm_source"] = lambda v: merge.merged_source(
    v["orders"].select(F.col("o_orderdate").alias("source_release_date")), _MERGED, 3, "5.4", "v5.0", _DAY)
CHECKS["merged_cdm_source"] = """
SELECT 'Merged records' AS cdm_source_name, 'MR' AS cdm_source_abbreviation, 'Coordinating center' AS cdm_holder,
       'Records of 3 sites' AS source_description, '' AS source_documentation_reference, '' AS cdm_etl_reference,
       CAST(max(o_orderdate) AS DATE) AS source_release_date, DATE '2024-05-01' AS cdm_release_date,
       '5.4' AS cdm_version, CAST(756265 AS BIGINT) AS cdm_version_concept_id, 'v5.0' AS vocabulary_version FROM orders"""

# ---- run log ----

_SITE = "site 3"
_START = "timestamp_ntz'2024-05-01 10:00:00'"
_END = "timestamp_ntz'2024-05-01 11:00:00'"


def _log(v: Views):
    base = v["f_log"].select(
        "site_name", "delivery_date", "status", "message", F.expr(_START).alias("pipeline_start_datetime"),
        F.when(F.col("status").isin("completed", "error"), F.expr(_END)).alias("pipeline_end_datetime"),
        F.lit("csv").alias("file_format"), F.lit("5.3").alias("cdm_version"), "run_id")
    return base.select(*[F.col(f.name).cast(f.dataType) for f in runlog.LOG_SCHEMA])


def _starts(v: Views):
    return v["f_log_starts"].select(
        "site_name", "delivery_date", F.expr(_END).alias("pipeline_start_datetime"),
        F.lit("parquet").alias("file_format"), F.lit("5.4").alias("cdm_version"), "run_id")


def _state(v: Views):
    """Restart some deliveries, then run, fail and complete others."""
    log = runlog.log_started(_log(v), _starts(v))
    base = v["f_log"]
    log = runlog.log_running(log, base.filter("run_id LIKE '%1'").select("site_name", "delivery_date"))
    errors = base.filter("run_id LIKE '%3' OR run_id LIKE '%7'").select(
        "run_id", F.expr(_END).alias("pipeline_end_datetime"),
        F.when(F.col("run_id").like("%3"), "DAG failed").otherwise("out of space").alias("message"))
    log = runlog.log_failed(log, errors)
    ends = base.filter("run_id LIKE '%9'").select(
        "site_name", "delivery_date", F.expr("timestamp_ntz'2024-05-01 12:00:00'").alias("pipeline_end_datetime"))
    return runlog.log_completed(log, ends)


_BASE = ("base", """
    SELECT site_name, delivery_date, status, message, TIMESTAMP '2024-05-01 10:00:00' AS started,
           CASE WHEN status IN ('completed', 'error') THEN TIMESTAMP '2024-05-01 11:00:00' END AS ended,
           'csv' AS file_format, '5.3' AS cdm_version, run_id FROM f_log""")
_STARTED = ("begun", """
    SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM f_log_starts s WHERE s.site_name = b.site_name AND s.delivery_date = b.delivery_date)
    UNION ALL SELECT site_name, delivery_date, 'started', NULL, TIMESTAMP '2024-05-01 11:00:00', NULL, 'parquet', '5.4', run_id
    FROM f_log_starts""")
_HIT = "EXISTS (SELECT 1 FROM f_log l WHERE l.site_name = r.site_name AND l.delivery_date = r.delivery_date AND l.run_id LIKE '{0}')"
_RUN = ("running", f"""
    SELECT * REPLACE (CASE WHEN hit THEN 'running' ELSE status END AS status, CASE WHEN hit THEN NULL ELSE message END AS message,
                      CASE WHEN hit THEN NULL ELSE ended END AS ended)
    FROM (SELECT *, status <> 'running' AND {_HIT.format('%1')} AS hit FROM begun r)""")
_FAILED = ("failed", """
    SELECT site_name, delivery_date, CASE WHEN bad THEN 'error' ELSE status END AS status,
           CASE WHEN NOT bad THEN message WHEN run_id LIKE '%7' THEN 'out of space'
                WHEN coalesce(message, '') <> '' THEN message ELSE 'DAG failed' END AS message,
           started, CASE WHEN bad THEN TIMESTAMP '2024-05-01 11:00:00' ELSE ended END AS ended, file_format, cdm_version, run_id
    FROM (SELECT *, run_id LIKE 'run%3' OR run_id LIKE 'run%7' AS bad FROM running)""")
_STATE = f"""
    SELECT site_name, delivery_date, CASE WHEN done THEN 'completed' ELSE status END AS status,
           CASE WHEN done THEN NULL ELSE message END AS message, started AS pipeline_start_datetime,
           CASE WHEN done THEN TIMESTAMP '2024-05-01 12:00:00' ELSE ended END AS pipeline_end_datetime,
           file_format, cdm_version, run_id
    FROM (SELECT *, {_HIT.format('%9')} AS done FROM failed r)"""
_STEPS = [_BASE, _STARTED, _RUN, _FAILED]
QUERIES["runlog_state"] = _state
CHECKS["runlog_state"] = with_views(_STATE, *_STEPS)


def _logged(v: Views):
    """The same steps, each committed to a stored log by a writer of its own."""
    root = storage.scratch_path(v.spark, "runlog")
    base = v["f_log"]
    keys = ["site_name", "delivery_date"]
    errors = base.filter("run_id LIKE '%3' OR run_id LIKE '%7'").select(
        "run_id", F.expr(_END).alias("pipeline_end_datetime"),
        F.when(F.col("run_id").like("%3"), "DAG failed").otherwise("out of space").alias("message"))
    ends = base.filter("run_id LIKE '%9'").select(
        *keys, F.expr("timestamp_ntz'2024-05-01 12:00:00'").alias("pipeline_end_datetime"))
    for change in (
        lambda log: log.unionByName(_log(v)), lambda log: runlog.log_started(log, _starts(v)),
        lambda log: runlog.log_running(log, base.filter("run_id LIKE '%1'").select(*keys)),
        lambda log: runlog.log_failed(log, errors), lambda log: runlog.log_completed(log, ends),
    ):
        runlog.RunLog(v.spark, root).commit(change)
    return runlog.RunLog(v.spark, root).read()


QUERIES["runlog_table"] = _logged
CHECKS["runlog_table"] = CHECKS["runlog_state"]
QUERIES["latest_completed"] = lambda v: runlog.latest_completed(_state(v))
CHECKS["latest_completed"] = with_views(
    f"SELECT site_name, max(delivery_date) AS delivery_date FROM ({_STATE}) WHERE status = 'completed' GROUP BY 1", *_STEPS)
QUERIES["log_rows"] = lambda v: runlog.log_rows(_state(v), _SITE, F.col("delivery_date"))
CHECKS["log_rows"] = with_views(f"SELECT * FROM ({_STATE}) WHERE site_name = '{_SITE}'", *_STEPS)
