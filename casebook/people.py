"""Delivered people against the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.views import Views, with_views
from medloom.operators import metrics, participants as p
from medloom.plans import report

QUERIES, CHECKS = {}, {}

_YES = "IN ('353358909')"
_EXCLUDED = ("excluded", f"""
    SELECT DISTINCT CAST(connect_id AS BIGINT) AS id FROM f_registry
    WHERE verified_status_concept_id <> '197316935' OR consent_withdrawn_concept_id {_YES}
       OR hipaa_revoked_concept_id {_YES} OR data_destruction_requested_concept_id {_YES}""")
_KNOWN = ("known", "SELECT DISTINCT CAST(connect_id AS BIGINT) AS id FROM f_registry")
# A delivery in which some ids are missing or unreadable.
_ROWS = """
SELECT CASE WHEN o_orderkey % 31 = 0 THEN '-1' WHEN o_orderkey % 37 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS person_id,
       o_orderkey FROM orders"""
_BAD_ROWS = """
SELECT CASE o_orderkey % 3 WHEN 0 THEN concat('x', CAST(o_custkey AS STRING)) WHEN 1 THEN ' ' ELSE '17' END AS person_id
FROM orders WHERE o_orderkey % 37 = 0"""
_STATUSES = ["verified_status", "consent_withdrawn", "hipaa_revoked", "data_destruction_requested"]


def _labelled(v: Views) -> DataFrame:
    """The registry with its status labels; a blank one now and then."""
    labels = F.create_map(*[F.lit(x) for pair in _LABELS.items() for x in pair])
    registry = v["f_registry"]
    for name in _STATUSES:
        code = F.coalesce(F.col(f"{name}_concept_id"), F.lit(""))
        registry = registry.withColumn(name, F.when(F.col("connect_id").cast("long") % 41 == 0, F.lit(" ")).otherwise(labels[code]))
    return registry


QUERIES["participant_filter"] = lambda v: p.eligible_rows(v.sql(_ROWS), v["f_registry"])
CHECKS["participant_filter"] = with_views(
    f"""SELECT person_id, o_orderkey FROM ({_ROWS}) JOIN known ON id = try_cast(person_id AS BIGINT)
        WHERE try_cast(person_id AS BIGINT) <> -1 AND id NOT IN (SELECT id FROM excluded)""", _KNOWN, _EXCLUDED)

QUERIES["removal_buckets"] = lambda v: p.removal_counts(v.sql(_ROWS), v["f_registry"])
CHECKS["removal_buckets"] = with_views(
    f"""SELECT count(*) FILTER (reason = 1) AS unknown_identifier_count,
               count(*) FILTER (reason = 2) AS identifier_not_in_registry_count,
               count(*) FILTER (reason = 3) AS exclusion_rules_count
        FROM (SELECT CASE WHEN coalesce(try_cast(person_id AS BIGINT), -1) = -1 THEN 1
                          WHEN try_cast(person_id AS BIGINT) NOT IN (SELECT id FROM known) THEN 2
                          WHEN try_cast(person_id AS BIGINT) IN (SELECT id FROM excluded) THEN 3 ELSE 0 END AS reason
              FROM ({_ROWS}))""", _KNOWN, _EXCLUDED)

_UNMATCHED = ("unmatched", f"""
    SELECT DISTINCT CAST(try_cast(person_id AS BIGINT) AS VARCHAR) AS unmatched_id FROM ({_ROWS})
    WHERE try_cast(person_id AS BIGINT) <> -1 AND try_cast(person_id AS BIGINT) NOT IN (SELECT id FROM known)
    UNION SELECT person_id FROM ({_BAD_ROWS}) WHERE trim(person_id) <> '' AND try_cast(person_id AS BIGINT) IS NULL""")
QUERIES["unmatched_ids"] = lambda v: p.unmatched_ids(v.sql(_ROWS), v["f_registry"], v.sql(_BAD_ROWS))
CHECKS["unmatched_ids"] = with_views("SELECT * FROM unmatched", _KNOWN, _UNMATCHED)
QUERIES["ids_not_in_registry"] = lambda v: p.patient_count(
    p.unmatched_ids(v.sql(_ROWS), v["f_registry"], v.sql(_BAD_ROWS)))
CHECKS["ids_not_in_registry"] = with_views("SELECT count(*) AS patient_count FROM unmatched", _KNOWN, _UNMATCHED)

_UNDELIVERED = ("undelivered", f"""
    SELECT DISTINCT CAST(connect_id AS BIGINT) AS connect_id FROM f_registry
    WHERE coalesce(verified_status_concept_id, '0') = '197316935'
      AND NOT coalesce(consent_withdrawn_concept_id {_YES}, FALSE) AND NOT coalesce(hipaa_revoked_concept_id {_YES}, FALSE)
      AND NOT coalesce(data_destruction_requested_concept_id {_YES}, FALSE)
      AND CAST(connect_id AS BIGINT) NOT IN (SELECT person_id FROM f_person)""")
QUERIES["registry_not_delivered"] = lambda v: p.undelivered_ids(v["f_registry"], v["f_person"])
CHECKS["registry_not_delivered"] = with_views("SELECT * FROM undelivered", _UNDELIVERED)
QUERIES["registry_not_delivered_report"] = lambda v: p.patient_count(p.undelivered_ids(v["f_registry"], v["f_person"]))
CHECKS["registry_not_delivered_report"] = with_views("SELECT count(*) AS patient_count FROM undelivered", _UNDELIVERED)

# Codes and labels as the registry writes them.
_LABELS = {
    "197316935": "Verified", "875007964": "Not Yet Verified", "290379732": "No Longer Enrolling",
    "160161595": "Outreach timed Out", "922622075": "Duplicate", "219863910": "Cannot be Verified", "104430631": "No",
    "353358909": "Yes",
}


def _statuses_sql() -> str:
    names = "MAP {" + ", ".join(f"'{code}': '{label}'" for code, label in _LABELS.items()) + "}"
    branches = []
    for status in _STATUSES:
        code = f"CAST({status}_concept_id AS BIGINT)"
        label = (f"CASE WHEN CAST(connect_id AS BIGINT) % 41 = 0 THEN 'UNKNOWN'"
                 f" ELSE coalesce({names}[{status}_concept_id], 'UNKNOWN') END")
        listed = f"{code} <> 197316935" if status == "verified_status" else f"{code} = 353358909"
        branches.append(f"""
        SELECT DISTINCT '{status}' AS status_kind, {label} AS status_value, {code} AS status_concept_id,
               CAST(connect_id AS BIGINT) AS person_id, coalesce({listed}, FALSE) AS listed
        FROM f_registry WHERE CAST(connect_id AS BIGINT) IN (SELECT person_id FROM f_person)""")
    return " UNION ALL ".join(branches)


QUERIES["status_breakdown"] = lambda v: p.status_breakdown(_labelled(v), v["f_person"])
CHECKS["status_breakdown"] = with_views(f"""
    SELECT status_kind, status_value, status_concept_id, count(DISTINCT person_id) AS patient_count
    FROM ({_statuses_sql()}) GROUP BY 1, 2, 3""")
QUERIES["status_ids"] = lambda v: p.status_ids(_labelled(v), v["f_person"])
CHECKS["status_ids"] = with_views(
    f"SELECT status_kind, status_value, status_concept_id, person_id FROM ({_statuses_sql()}) WHERE listed")

# ---- the study summary ----


def _summary(v: Views) -> DataFrame:
    tables = {"person": v["f_person"], "death": v.sql(_ROWS)}
    registry, invalid = _labelled(v), {"death": v.sql(_BAD_ROWS)}
    valid = metrics.metric_frame(v.spark, [metrics.Metric("Valid row count: person", value_as_number=7.0)])
    found = metrics.unite([valid, report.registry(tables, registry, invalid)])
    return report.study_summary(v.spark, found, report.registry_ids(tables, registry, invalid))


_TABLES = ["condition_era", "condition_occurrence", "death", "device_exposure", "dose_era", "drug_era", "drug_exposure",
           "episode", "measurement", "note", "observation", "observation_period", "payer_plan_period", "person",
           "procedure_occurrence", "specimen", "visit_detail", "visit_occurrence"]
# (title, kind, value, whether ids follow)
_TITLES = [
    ("Consent withdrawn", "consent_withdrawn", "yes", True), ("Consent not withdrawn", "consent_withdrawn", "no", False),
    ("HIPAA revoked", "hipaa_revoked", "yes", True), ("HIPAA not revoked", "hipaa_revoked", "no", False),
    ("Data destruction requested", "data_destruction_requested", "yes", True),
    ("Data destruction not requested", "data_destruction_requested", "no", False),
    ("Study status - Verified", "verified_status", "verified", False),
    *[(f"Study status - {t}", "verified_status", t.lower(), True) for t in (
        "Duplicate", "Not Yet Verified", "Cannot be Verified", "No Longer Enrolling", "Outreach Timed Out")],
]


def _summary_sql() -> str:
    """One branch for each line, and one for the ids below it."""
    out, line = ["SELECT 0 AS line_no, CAST(NULL AS VARCHAR) AS id, 'Person record count: 7' AS line"], 2

    def counted(text: str, ids: str, with_ids: bool) -> None:
        nonlocal line
        after = "):" if with_ids else ""
        before = f"{text} (" if with_ids else f"{text}: "
        out.append(f"SELECT {line}, CAST(NULL AS VARCHAR), concat('{before}', (SELECT count(*) FROM ({ids})), '{after}')")
        if with_ids:
            out.append(f"SELECT {line}, CAST(id AS VARCHAR), concat('    ', id) FROM ({ids})")
        line += 1

    delivered = {"death": "SELECT unmatched_id AS id FROM unmatched",
                 "person": "SELECT DISTINCT person_id AS id FROM f_person WHERE person_id <> -1 AND person_id NOT IN (SELECT id FROM known)"}
    total = " UNION ALL ".join(f"SELECT CAST(id AS VARCHAR) FROM ({ids})" for ids in delivered.values())
    out.append(f"SELECT 1, CAST(NULL AS VARCHAR), concat('Delivered study ids not found in registry (', (SELECT count(*) FROM ({total})), '):')")
    for table in _TABLES:
        counted(f"  {table}", delivered.get(table, "SELECT 1 AS id WHERE FALSE"), True)
    for title, kind, value, with_ids in _TITLES:
        counted(title, f"SELECT DISTINCT person_id AS id FROM statuses WHERE status_kind = '{kind}' AND lower(status_value) = '{value}'"
                + (" AND listed" if with_ids else ""), with_ids)
    counted("Eligible participants not in delivery", "SELECT connect_id AS id FROM undelivered", True)
    return " UNION ALL ".join(out)


QUERIES["study_summary"] = _summary
CHECKS["study_summary"] = with_views(
    _summary_sql(), _KNOWN, _UNMATCHED, _UNDELIVERED, ("statuses", _statuses_sql()))


# Variables of the registry: fixed values.
_STATUS_VARIABLES = {
    "verified_status": "d_821247024", "consent_withdrawn": "d_747006172", "hipaa_revoked": "d_773707518",
    "data_destruction_requested": "d_831041022",
}
_COMPLETION = {"972455046": "Not Started", "615768760": "Started", "231311385": "Submitted"}
_SURVEY_VARIABLES = {
    "module1_status": "d_949302066", "module2_status": "d_536735468", "module3_status": "d_976570371",
    "module4_status": "d_663265240", "menstrual_status": "d_459098666", "covid19_status": "d_220186468",
    "experience2024_status": "d_956490759",
}
_MOMENTS = {
    "consent_withdrawn_ts": "d_659990606", "hipaa_revoked_ts": "d_664453818", "data_destruction_ts": "d_269050420",
    "module1_complete_ts": "d_517311251", "module2_complete_ts": "d_832139544", "module3_complete_ts": "d_770257102",
    "module4_complete_ts": "d_264644252", "menstrual_complete_ts": "d_217640691", "covid19_complete_ts": "d_784810139",
    "experience2024_complete_ts": "d_199471989",
}


def _decode_sql() -> str:
    def label(table: dict[str, str], variable: str) -> str:
        whens = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in table.items())
        return f"CASE {variable} {whens} ELSE 'UNKNOWN' END"

    columns = ["connect_id"]
    for table, variables in ((_LABELS, _STATUS_VARIABLES), (_COMPLETION, _SURVEY_VARIABLES)):
        for name, variable in variables.items():
            columns += [f"{label(table, variable)} AS {name}", f"{variable} AS {name}_concept_id"]
    columns += [f"{variable} AS {name}" for name, variable in _MOMENTS.items()]
    return f"SELECT DISTINCT {', '.join(columns)} FROM f_participants WHERE connect_id IS NOT NULL"


QUERIES["status_decode"] = lambda v: p.decode_status(v["f_participants"])
CHECKS["status_decode"] = with_views(_decode_sql())
QUERIES["status_decode_site"] = lambda v: p.decode_status(v["f_participants"], F.col("site") == "BUILDING")
CHECKS["status_decode_site"] = with_views(_decode_sql() + " AND site = 'BUILDING'")
