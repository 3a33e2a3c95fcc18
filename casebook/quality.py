"""Quality metrics, clean-up tasks and their differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from casebook.harmonization import DRUG_CHAIN, harmonized_drugs
from casebook.sql import digest
from casebook.views import Views, with_views
from medloom import schema
from medloom.operators import diff, metrics as m
from medloom.plans import report, tasks

QUERIES, CHECKS = {}, {}

_UNTIL = dt.date(2001, 6, 30)
_FIELDS = ["measurement_concept_id", "measurement_source_concept_id", "unit_concept_id", "unit_source_concept_id"]
_USAGE = " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS concept_id FROM f_measurement" for f in _FIELDS)


def _delivery(v: Views):
    return {"person": v["f_person"], "measurement": v["f_measurement"], "drug_exposure": v["f_drug"],
            "visit_occurrence": v["f_visit"], "death": v["f_death"]}


QUERIES["concept_usage"] = lambda v: m.concept_usage(v["f_measurement"], _FIELDS)
CHECKS["concept_usage"] = with_views(f"SELECT field, concept_id, count(*) AS n FROM ({_USAGE}) GROUP BY 1, 2")

# Type concepts named by the parts of a vocabulary that starts at 32800.
_TYPES = "SELECT p_partkey + 32802 AS concept_id, p_name AS concept_name FROM part"
QUERIES["type_breakdown"] = lambda v: m.type_breakdown(
    m.concept_usage(v["f_drug"], ["drug_type_concept_id"]), v.sql(_TYPES))
CHECKS["type_breakdown"] = with_views(
    f"""SELECT 'drug_type_concept_id' AS field, coalesce(drug_type_concept_id, 0) AS type_concept_id,
               coalesce(concept_name, 'No matching concept') AS concept_name, count(*) AS record_count
        FROM f_drug LEFT JOIN ({_TYPES}) t ON concept_id = drug_type_concept_id GROUP BY 2, 3""")

QUERIES["vocabulary_breakdown"] = lambda v: m.vocabulary_breakdown(
    m.concept_usage(v["f_measurement"], _FIELDS), v["f_concept"])
CHECKS["vocabulary_breakdown"] = with_views(
    f"""SELECT field, coalesce(vocabulary_id, 'No matching concept') AS vocabulary_id, count(*) AS record_count
        FROM ({_USAGE}) u LEFT JOIN f_concept c ON c.concept_id = u.concept_id GROUP BY 1, 2""")

QUERIES["invalid_concepts"] = lambda v: m.invalid_concepts(
    m.concept_usage(v["f_measurement"], _FIELDS), v["f_concept"])
CHECKS["invalid_concepts"] = with_views(
    f"""SELECT field, count(*) FILTER (concept_id <> 0 AND concept_id NOT IN (SELECT concept_id FROM f_concept))
               AS invalid_count FROM ({_USAGE}) GROUP BY 1""")

QUERIES["default_dates"] = lambda v: m.default_dates(
    v["f_measurement"].withColumn("measurement_datetime", F.col("measurement_date").cast("timestamp_ntz")),
    ["measurement_date", "measurement_datetime"])
CHECKS["default_dates"] = with_views(
    """SELECT field, count(*) FILTER (measurement_date = DATE '1970-01-01') AS default_count
       FROM f_measurement, (VALUES ('measurement_date'), ('measurement_datetime')) t(field) GROUP BY 1""")

QUERIES["rows_per_year"] = lambda v: m.rows_per_year(v["f_drug"], "drug_exposure_start_date", _UNTIL)
CHECKS["rows_per_year"] = with_views(
    """SELECT CAST(year(drug_exposure_start_date) AS INTEGER) AS year, count(*) AS row_count FROM f_drug
       WHERE drug_exposure_start_date BETWEEN DATE '1970-01-01' AND DATE '2001-06-30' GROUP BY 1""")

QUERIES["final_row_counts"] = lambda v: m.row_counts(v.spark, _delivery(v))
_COUNTED = {"person": "f_person", "measurement": "f_measurement", "drug_exposure": "f_drug",
            "visit_occurrence": "f_visit", "death": "f_death"}
CHECKS["final_row_counts"] = with_views(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {_COUNTED[t]}" if t in _COUNTED
    else f"SELECT '{t}', CAST(0 AS BIGINT)" for t in sorted(schema.tables(), key=lambda t: t not in _COUNTED)))

QUERIES["orphan_persons"] = lambda v: m.orphan_rows(v["f_drug"], v["f_person"])
CHECKS["orphan_persons"] = with_views(
    "SELECT count(*) AS violation_count FROM f_drug WHERE person_id NOT IN (SELECT person_id FROM f_person)")

# ---- the report as a whole ----

def _about(v: Views) -> report.Delivery:
    return report.Delivery(v.spark, _delivery(v), v["f_concept"], _UNTIL, {"Site": "site a"})


_RUN = dt.datetime(2001, 7, 1, 8, 30)


def _finished(rows):
    """All columns of the metadata table but the id, which is a hash of the others."""
    return m.finish_report(rows, _RUN).drop("metadata_id")


def _rows(sql: str) -> str:
    """The same for (name, value_as_string, value_as_number) and, if they differ from 0, the concepts."""
    return f"""
    SELECT CAST(0 AS INTEGER) AS metadata_concept_id, CAST(32880 AS INTEGER) AS metadata_type_concept_id, name, value_as_string,
           CAST(0 AS INTEGER) AS value_as_concept_id, CAST(value_as_number AS DOUBLE) AS value_as_number,
           DATE '2001-07-01' AS metadata_date, TIMESTAMP '2001-07-01 08:30:00' AS metadata_datetime FROM ({sql})"""


QUERIES["report_integrity"] = lambda v: _finished(report.artifact(_about(v), "person_id_integrity"))
_INTEGRITY = (" UNION ALL ".join(
    f"""SELECT 'Person_id referential integrity violation count: {t}' AS name, '{t}' AS value_as_string,
               CAST(count(*) FILTER (person_id NOT IN (SELECT person_id FROM f_person)) AS DOUBLE) AS value_as_number
        FROM {view}""" for t, view in _COUNTED.items() if t != "person"))
CHECKS["report_integrity"] = with_views(_rows(_INTEGRITY))
QUERIES["report_time_series"] = lambda v: _finished(report.artifact(_about(v), "time_series"))
_DATED = {"measurement": "measurement_date", "drug_exposure": "drug_exposure_start_date",
          "visit_occurrence": "visit_start_date"}
_SERIES = (" UNION ALL ".join(
    f"""SELECT concat('Time series row count: {t}.', year({c})) AS name, concat('{t}.', year({c})) AS value_as_string,
               CAST(count(*) AS DOUBLE) AS value_as_number
        FROM {_COUNTED[t]} WHERE {c} BETWEEN DATE '1970-01-01' AND DATE '2001-06-30' GROUP BY 1, 2"""
    for t, c in _DATED.items()))
CHECKS["report_time_series"] = with_views(_rows(_SERIES))
QUERIES["report_final_counts"] = lambda v: _finished(report.artifact(_about(v), "final_row_counts"))
CHECKS["report_final_counts"] = _rows(
    "SELECT concat('Final row count: ', table_name) AS name, table_name AS value_as_string,"
    f" row_count AS value_as_number FROM ({CHECKS['final_row_counts']})")
_MOVES = """
    SELECT concat('Vocab harmonization table transition: drug_exposure to ', target_table) AS name, count(*) AS n FROM harmonized GROUP BY 1
    UNION ALL SELECT concat('Vocab harmonization status: drug_exposure - ', vocab_harmonization_status), count(*) FROM harmonized GROUP BY 1
    UNION ALL SELECT concat('Vocab harmonization same-table mapping: drug_exposure - 1:', k), sum(n)
              FROM (SELECT count(DISTINCT target_concept_id) AS k, count(*) AS n FROM harmonized
                    WHERE target_table = 'drug_exposure' GROUP BY drug_exposure_id) GROUP BY 1
    UNION ALL SELECT concat('Vocab harmonization row disposition: drug_exposure - ', CASE WHEN low = high AND low
                            THEN 'stayed only' WHEN high THEN 'stayed and copied' ELSE 'moved to other tables' END), count(*)
              FROM (SELECT min(target_table = 'drug_exposure') AS low, max(target_table = 'drug_exposure') AS high
                    FROM harmonized GROUP BY drug_exposure_id) GROUP BY 1"""
QUERIES["report_harmonization"] = lambda v: _finished(
    report.harmonization(harmonized_drugs(v), "drug_exposure", "drug_exposure_id"))
CHECKS["report_harmonization"] = with_views(
    _rows(f"SELECT name, CAST(NULL AS VARCHAR) AS value_as_string, n AS value_as_number FROM ({_MOVES})"), *DRUG_CHAIN)

# Concept fields of the given tables: (table, target field, its source field: None if the model has none, empty if not delivered).
_TARGETS = [("measurement", "measurement_concept_id", "measurement_source_concept_id"),
            ("measurement", "unit_concept_id", "unit_source_concept_id"), ("measurement", "value_as_concept_id", None),
            ("drug_exposure", "drug_concept_id", "drug_source_concept_id"), ("visit_occurrence", "visit_concept_id", ""),
            ("person", "gender_concept_id", "")]


def _all_sql() -> str:
    parts = ["SELECT 'Delivery date' AS name, '2001-06-30' AS value_as_string, CAST(NULL AS DOUBLE) AS value_as_number, 0 AS c, 0 AS k",
             "SELECT 'Site', 'site a', NULL, 0, 0"]
    for table, kind in (("measurement", "measurement_type_concept_id"), ("drug_exposure", "drug_type_concept_id")):
        parts.append(f"""SELECT 'Type concept breakdown: {table}', coalesce(concept_name, 'No matching concept'), count(*),
            coalesce({kind}, 0), coalesce({kind}, 0) FROM {_COUNTED[table]} t LEFT JOIN f_concept c ON c.concept_id = t.{kind} GROUP BY ALL""")
        parts.append(f"""SELECT 'Invalid concept_id count: {table}.{kind}', '{table}.{kind}', count(*) FILTER ({kind} <> 0
            AND {kind} NOT IN (SELECT concept_id FROM f_concept)), 0, 0 FROM {_COUNTED[table]}""")
    for table, target, source in _TARGETS:
        parts.append(f"""SELECT 'Invalid concept_id count: {table}.{target}', '{table}.{target}', count(*) FILTER ({target} <> 0
            AND {target} NOT IN (SELECT concept_id FROM f_concept)), 0, 0 FROM {_COUNTED[table]}""")
        for side, column in (("Target", target), ("Source", source)):
            if column == "":
                continue
            parts.append(f"""SELECT '{side} vocabulary breakdown: {table}.{target}', coalesce(vocabulary_id, 'No matching concept'), count(*), 0, 0
                FROM {_COUNTED[table]} t LEFT JOIN f_concept c ON c.concept_id = t.{column} GROUP BY ALL""" if column else
                f"SELECT 'Source vocabulary breakdown: {table}.{target}', 'Source vocabulary not captured in the model', NULL, 0, 0")
    dated = [("measurement", "measurement_date"), ("drug_exposure", "drug_exposure_start_date"), ("drug_exposure", "drug_exposure_end_date"),
             ("visit_occurrence", "visit_start_date"), ("visit_occurrence", "visit_end_date"), ("death", "death_date")]
    for table, column in dated:
        parts.append(f"""SELECT 'Date/datetime default value count: {table}.{column}', NULL, count(*) FILTER ({column} = DATE '1970-01-01'), 0, 0
            FROM {_COUNTED[table]}""")
    rest = [_INTEGRITY, _SERIES, f"SELECT concat('Final row count: ', table_name), table_name, row_count FROM ({CHECKS['final_row_counts']})"]
    parts += [f"SELECT *, 0, 0 FROM ({part})" for part in rest]
    return " UNION ALL ".join(f"SELECT * FROM ({part})" for part in parts)


QUERIES["report_all"] = lambda v: report.generate(_about(v), [], _RUN).drop("metadata_id")
CHECKS["report_all"] = with_views(f"""
    SELECT CAST(k AS INTEGER) AS metadata_concept_id, CAST(32880 AS INTEGER) AS metadata_type_concept_id, name, value_as_string,
           CAST(c AS INTEGER) AS value_as_concept_id, CAST(value_as_number AS DOUBLE) AS value_as_number,
           DATE '2001-07-01' AS metadata_date, TIMESTAMP '2001-07-01 08:30:00' AS metadata_datetime FROM ({_all_sql()})""")

# ---- clean-up tasks ----

# Reviewed concepts that stay.
_ALLOWED = "4020553, 44816618, 21490847, 36674488, 3020891, 4140731, 4137519, 4134573, 4139702, 4141359, 1988764, 4177340"
_KEPT = f"""NOT (measurement_concept_id <> 0 AND measurement_source_concept_id = 0
    AND length(coalesce(measurement_source_value, '')) > 5 AND measurement_concept_id NOT IN ({_ALLOWED}))"""
QUERIES["text_mapped_filter"] = lambda v: tasks.drop_text_mapped(v["f_measurement"])
CHECKS["text_mapped_filter"] = with_views(f"SELECT * FROM f_measurement WHERE {_KEPT}")

_TASK = {"measurement": "SELECT * FROM {measurement} WHERE value_as_concept_id % 3 <> 0",
         "death": "SELECT person_id, date_add(death_date, CAST(person_id % 2 AS INT)) AS death_date FROM {death}"}


def _task(v: Views):
    tables = {"measurement": v["f_measurement"], "death": v["f_death"], "person": v["f_person"]}
    return tasks.run_task("thin out", tables, _TASK)


QUERIES["task_result"] = lambda v: _task(v).tables["death"]
CHECKS["task_result"] = with_views(
    "SELECT person_id, death_date + CAST(person_id % 2 AS INTEGER) AS death_date FROM f_death")
QUERIES["task_metrics"] = lambda v: _finished(_task(v).metrics())
CHECKS["task_metrics"] = with_views(_rows(
    """SELECT concat('Post-processing task thin out: ', what) AS name, t AS value_as_string, CAST(n AS DOUBLE) AS value_as_number
       FROM (SELECT 'rows added' AS what, 'measurement' AS t, 0 AS n
             UNION ALL SELECT 'rows removed', 'measurement', (SELECT count(*) FROM f_measurement WHERE value_as_concept_id % 3 = 0)
             UNION ALL SELECT 'table affected', 'measurement', NULL
             UNION ALL SELECT 'rows added', 'death', (SELECT count(*) FROM f_death WHERE person_id % 2 = 1)
             UNION ALL SELECT 'rows removed', 'death', (SELECT count(*) FROM f_death WHERE person_id % 2 = 1)
             UNION ALL SELECT 'table affected', 'death', NULL)"""))

_AFTER = "SELECT o_orderkey + CASE WHEN o_orderkey % 10 = 3 THEN 5 ELSE 0 END AS k, o_custkey % 7 AS c FROM orders"
_BEFORE = "SELECT o_orderkey AS k, o_custkey % 7 AS c FROM orders"
QUERIES["snapshot_diff_pk"] = lambda v: diff.diff_by_key(v.sql(_BEFORE), v.sql(_AFTER), "k")
CHECKS["snapshot_diff_pk"] = f"""
SELECT (SELECT count(*) FROM ({_AFTER}) WHERE k NOT IN (SELECT k FROM ({_BEFORE}))) AS added,
       (SELECT count(*) FROM ({_BEFORE}) WHERE k NOT IN (SELECT k FROM ({_AFTER}))) AS removed"""
QUERIES["snapshot_diff_hash"] = lambda v: diff.diff_by_content(v.sql(_BEFORE), v.sql(_AFTER))
_HASH = digest(["k", "c"])
CHECKS["snapshot_diff_hash"] = f"""
SELECT (SELECT count(*) FROM ({_AFTER}) WHERE {_HASH} NOT IN (SELECT {_HASH} FROM ({_BEFORE}))) AS added,
       (SELECT count(*) FROM ({_BEFORE}) WHERE {_HASH} NOT IN (SELECT {_HASH} FROM ({_AFTER}))) AS removed"""
