"""Re-coding, routing and key repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.sql import SITE, VOCAB, chain, digest, key
from casebook.views import Views, with_views
from medloom import schema
from medloom.operators import dedupe, harmonize as h
from medloom.operators.normalize import conform
from medloom.operators.routing import route
from medloom.operators.vocabulary import Vocabulary, concept_lookup
from medloom.sources.storage import shared_folder

QUERIES, CHECKS = {}, {}

DRUG = ["drug_exposure_id", "dup_key", "person_id", "drug_concept_id", "drug_source_concept_id", "drug_type_concept_id",
        "drug_exposure_start_date", "drug_exposure_end_date", "days_supply", "visit_occurrence_id", "drug_source_value"]
MEASUREMENT = ["measurement_id", "person_id", "measurement_concept_id", "measurement_source_concept_id",
               "measurement_source_value", "measurement_date", "measurement_type_concept_id", "unit_concept_id",
               "unit_source_concept_id", "unit_source_value", "value_as_concept_id", "measurement_event_id"]
FINDING = ["condition_occurrence_id", "person_id", "condition_concept_id", "condition_source_concept_id",
           "condition_start_date", "condition_end_date", "condition_type_concept_id", "visit_occurrence_id",
           "condition_source_value", "condition_status_source_value", "condition_status_concept_id"]

DRUG_CHAIN = chain("f_drug", DRUG, "drug_exposure_id", "drug_concept_id", "drug_source_concept_id", "drug_exposure")
FULL_CHAIN = chain("f_drug", DRUG, "drug_exposure_id", "drug_concept_id", "drug_source_concept_id", "drug_exposure", True)
# Here different rows share a key, as delivered visit ids may.
SHARED_CHAIN = chain("f_drug", DRUG, "dup_key", "drug_concept_id", "drug_source_concept_id", "drug_exposure")
MEASUREMENT_CHAIN = chain("f_measurement", MEASUREMENT, "measurement_id", "measurement_concept_id",
                          "measurement_source_concept_id", "measurement")
FINDING_CHAIN = chain("f_finding", FINDING, "condition_occurrence_id", "condition_concept_id",
                      "condition_source_concept_id", "condition_occurrence")


# Lookups are made once for a vocabulary; a session looks for them once.
_STORED: dict[tuple[str, str, str], Vocabulary] = {}


def stored(v: Views, name: str, concept: DataFrame) -> Vocabulary:
    place = (v.spark.sparkContext.applicationId, v.sf_dir, name)
    if place not in _STORED:
        root = f"{shared_folder(v.spark).rstrip('/')}/medloom/vocabulary"
        _STORED[place] = Vocabulary.prepared(concept, v["f_concept_relationship"], root)
    return _STORED[place]


def vocabulary(v: Views) -> Vocabulary:
    return stored(v, "concepts", v["f_concept"])


def spread(v: Views) -> Views:
    """The same views over tables that are dealt over all cores, for work that is done row by row."""
    return Views(v.spark, v.sf_dir, spread=True)


def harmonized_drugs(v: Views, steps: list[str] | None = None, only_step: str | None = None) -> DataFrame:
    return h.harmonize(spread(v)["f_drug"], "drug_exposure", vocabulary(v), steps, only_step=only_step)


def _step(v: Views, step: str, steps: list[str]) -> DataFrame:
    return harmonized_drugs(v, steps, step)


def _step_check(status: str, entries) -> str:
    return with_views(f"SELECT * FROM harmonized WHERE vocab_harmonization_status = '{status}'", *entries)


QUERIES["vocab_lookup"] = lambda v: concept_lookup(v["f_concept"], v["f_concept_relationship"])
CHECKS["vocab_lookup"] = with_views("SELECT * FROM vocab", VOCAB)

for _name, _step_name, _steps, _entries in (
    ("source_target_remap", h.SOURCE_TARGET, h.DEFAULT_STEPS, DRUG_CHAIN),
    ("target_remap", h.TARGET_REMAP, h.DEFAULT_STEPS, DRUG_CHAIN),
    ("target_replacement", h.TARGET_REPLACEMENT, h.STEPS, FULL_CHAIN),
    ("source_backfill", h.SOURCE_BACKFILL, h.STEPS, FULL_CHAIN),
    ("domain_check", h.DOMAIN_CHECK, h.STEPS, FULL_CHAIN),
):
    QUERIES[_name] = lambda v, step=_step_name, steps=_steps: _step(v, step, steps)
    CHECKS[_name] = _step_check(h.STATUS[_step_name], _entries)

QUERIES["harmonize_chain"] = harmonized_drugs
CHECKS["harmonize_chain"] = with_views("SELECT * FROM harmonized", *DRUG_CHAIN)

QUERIES["harmonize_shared_keys"] = lambda v: h.harmonize(
    spread(v)["f_drug"], "drug_exposure", vocabulary(v), repeated_key="dup_key"
)
CHECKS["harmonize_shared_keys"] = with_views("SELECT * FROM harmonized", *SHARED_CHAIN)

QUERIES["exclude_settled"] = lambda v: h.exclude_settled(
    v["f_drug"], v["f_drug"].filter("drug_source_concept_id = 0"), "dup_key"
)
CHECKS["exclude_settled"] = with_views(
    "SELECT * FROM f_drug WHERE dup_key NOT IN (SELECT dup_key FROM f_drug WHERE drug_source_concept_id = 0)"
)

_PAIRS = [("unit_concept_id", "unit_source_concept_id")]
_FILLS = ("unit_concept_id = 0 AND unit_source_concept_id <> 0"
          " AND unit_source_concept_id IN (SELECT concept_id FROM f_concept)")
QUERIES["secondary_backfill"] = lambda v: h.backfill_secondary(v["f_measurement"], _PAIRS, vocabulary(v))
CHECKS["secondary_backfill"] = with_views(
    f"SELECT * REPLACE (CASE WHEN {_FILLS} THEN unit_source_concept_id ELSE unit_concept_id END AS unit_concept_id)"
    " FROM f_measurement"
)
QUERIES["secondary_backfill_counts"] = lambda v: h.secondary_backfill_counts(v["f_measurement"], _PAIRS, vocabulary(v))
CHECKS["secondary_backfill_counts"] = with_views(
    f"SELECT 'unit_concept_id' AS concept_column, count(*) AS row_count FROM f_measurement WHERE {_FILLS}"
)

# ---- what happened to the rows ----

QUERIES["table_transition"] = lambda v: h.transitions(harmonized_drugs(v))
CHECKS["table_transition"] = with_views(
    "SELECT target_table, count(*) AS row_count FROM harmonized GROUP BY 1", *DRUG_CHAIN)

QUERIES["target_tables"] = lambda v: h.target_tables(harmonized_drugs(v))
CHECKS["target_tables"] = with_views("SELECT DISTINCT target_table FROM harmonized", *DRUG_CHAIN)

QUERIES["status_counts"] = lambda v: h.status_counts(harmonized_drugs(v))
CHECKS["status_counts"] = with_views(
    "SELECT vocab_harmonization_status, count(*) AS row_count FROM harmonized GROUP BY 1", *DRUG_CHAIN)

QUERIES["mapping_cardinality"] = lambda v: h.mapping_cardinality(
    harmonized_drugs(v), "drug_exposure", "drug_exposure_id")
CHECKS["mapping_cardinality"] = with_views(
    """SELECT targets AS num_same_table_targets, CAST(sum(n) AS BIGINT) AS num_source_rows
       FROM (SELECT drug_exposure_id, count(DISTINCT target_concept_id) AS targets, count(*) AS n
             FROM harmonized WHERE target_table = 'drug_exposure' GROUP BY 1) GROUP BY 1""", *DRUG_CHAIN)

QUERIES["row_disposition"] = lambda v: h.row_disposition(harmonized_drugs(v), "drug_exposure", "drug_exposure_id")
CHECKS["row_disposition"] = with_views(
    """SELECT CASE WHEN same > 0 AND other = 0 THEN 'stayed only' WHEN same > 0 THEN 'stayed and copied'
                   ELSE 'moved to other tables' END AS disposition, count(*) AS row_count
       FROM (SELECT drug_exposure_id, count(*) FILTER (target_table = 'drug_exposure') AS same,
                    count(*) FILTER (target_table <> 'drug_exposure') AS other
             FROM harmonized GROUP BY 1) GROUP BY 1""", *DRUG_CHAIN)

# ---- routing ----


def _routed(v: Views, view: str, source: str, target: str) -> DataFrame:
    rows = conform(spread(v)[view], schema.layout(source))
    return route(h.harmonize(rows, source, vocabulary(v), only_table=target), source, target, SITE)


_KINDS = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE"}


# Fixed values of the model: what stands in for a required value.
_PLACEHOLDERS = {"bigint": "-1", "double": "-1.0", "date": "1970-01-01", "timestamp_ntz": "1970-01-01 00:00:00", "string": ""}


def _route_check(target: str, given: dict[str, str], entries, no_concept: str = "0") -> str:
    """Target columns from ``given``; the rest is ``no_concept`` for concepts and NULL otherwise."""
    layout = schema.layout(target)
    values = {f.name: given.get(f.name, no_concept if f.name.endswith("_concept_id") else "NULL") for f in layout}
    keyed = target != "visit_occurrence"
    columns = []
    for f in layout:
        kind = f.dataType.simpleString()
        value = key(list(values.values()), SITE) if keyed and f.metadata["pk"] else values[f.name]
        value = f"CAST({value} AS {_KINDS[kind]})"
        if f.metadata["required"] or f.name.endswith("_concept_id"):
            value = f"coalesce({value}, CAST('{'0' if f.name.endswith('_concept_id') else _PLACEHOLDERS[kind]}' AS {_KINDS[kind]}))"
        columns.append(f"{value} AS {f.name}")
    return with_views(f"SELECT {', '.join(columns)} FROM harmonized WHERE target_table = '{target}'", *entries)


QUERIES["route_d_to_m"] = lambda v: _routed(v, "f_drug", "drug_exposure", "measurement")
CHECKS["route_d_to_m"] = _route_check("measurement", {
    "measurement_id": "drug_exposure_id", "person_id": "person_id", "measurement_concept_id": "drug_concept_id",
    "measurement_date": "drug_exposure_start_date", "measurement_type_concept_id": "drug_type_concept_id",
    "value_as_concept_id": "coalesce(vh_value_as_concept_id, 0)", "visit_occurrence_id": "visit_occurrence_id",
    "measurement_source_value": "drug_source_value", "measurement_source_concept_id": "drug_source_concept_id",
}, DRUG_CHAIN)

QUERIES["route_m_to_o"] = lambda v: _routed(v, "f_measurement", "measurement", "observation")
CHECKS["route_m_to_o"] = _route_check("observation", {
    "observation_id": "measurement_id", "person_id": "person_id", "observation_concept_id": "measurement_concept_id",
    "observation_date": "measurement_date", "observation_type_concept_id": "measurement_type_concept_id",
    "value_as_concept_id": "coalesce(vh_value_as_concept_id, value_as_concept_id, 0)",
    "unit_concept_id": "unit_concept_id", "observation_source_value": "measurement_source_value",
    "observation_source_concept_id": "measurement_source_concept_id", "unit_source_value": "unit_source_value",
    "observation_event_id": "measurement_event_id", "obs_event_field_concept_id": "NULL",
}, MEASUREMENT_CHAIN)

_VISIT_VOCABULARY = "CASE WHEN p_partkey % 10 IN (1, 2) THEN 'Visit' ELSE 'Condition' END"


def _visit_vocabulary(v: Views) -> Vocabulary:
    concept = v.sql(f"SELECT p_partkey AS concept_id, {_VISIT_VOCABULARY} AS domain_id,"
                    " CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'S' END AS standard_concept FROM part")
    return stored(v, "visits", concept)


QUERIES["route_c_to_v"] = lambda v: route(
    h.harmonize(conform(v["f_finding"], schema.layout("condition_occurrence")), "condition_occurrence",
                _visit_vocabulary(v)), "condition_occurrence", "visit_occurrence", SITE)
CHECKS["route_c_to_v"] = _route_check("visit_occurrence", {
    "visit_occurrence_id": "condition_occurrence_id", "person_id": "person_id",
    "visit_concept_id": "condition_concept_id", "visit_start_date": "condition_start_date",
    "visit_end_date": "coalesce(condition_end_date, condition_start_date)",
    "visit_type_concept_id": "condition_type_concept_id", "visit_source_value": "condition_source_value",
    "visit_source_concept_id": "condition_source_concept_id",
}, [
    ("vocab", VOCAB[1].replace("f_concept c\n", f"(SELECT p_partkey AS concept_id, {_VISIT_VOCABULARY} AS domain_id,"
                               " CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'S' END AS standard_concept FROM part) c\n")
     .replace("f_concept t", f"(SELECT p_partkey AS concept_id, {_VISIT_VOCABULARY} AS domain_id,"
              " CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'S' END AS standard_concept FROM part) t")),
    *FINDING_CHAIN[1:],
])

QUERIES["route_identity"] = lambda v: _routed(v, "f_drug", "drug_exposure", "drug_exposure")
CHECKS["route_identity"] = _route_check("drug_exposure", {
    c: c for c in DRUG if c != "dup_key"
}, DRUG_CHAIN, no_concept="NULL")

# ---- key repair ----

_KEYED = ["dup_key", "person_id", "drug_concept_id", "drug_type_concept_id", "drug_exposure_start_date",
          "drug_source_value"]
_COPIES = f"SELECT {', '.join(_KEYED)} FROM f_drug"


def _with_copies(v: Views) -> DataFrame:
    # Every second row twice, so that keys repeat with equal and with different content. A row and its copy are made
    # from one reading: lines and orders are joined once, and the two are next to each other for what counts them.
    copies = F.when(F.col("person_id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return spread(v)["f_drug"].select(*_KEYED, F.explode(copies).alias("_copy")).drop("_copy")


_COPIES_SQL = f"{_COPIES} UNION ALL {_COPIES} WHERE person_id % 2 = 0"
QUERIES["dedupe_keys"] = lambda v: dedupe.repair_keys(_with_copies(v), "dup_key")
CHECKS["dedupe_keys"] = with_views(
    f"""SELECT CASE WHEN n = 1 THEN dup_key ELSE {key(['dup_key', 'n'])} END AS dup_key, {', '.join(_KEYED[1:])}
        FROM (SELECT *, row_number() OVER (PARTITION BY dup_key ORDER BY {digest(_KEYED[1:])}) AS n
              FROM ({_COPIES_SQL}))"""
)
QUERIES["repeated_keys"] = lambda v: dedupe.repeated_keys(_with_copies(v), "dup_key")
CHECKS["repeated_keys"] = with_views(
    f"SELECT dup_key, count(*) AS row_count FROM ({_COPIES_SQL}) GROUP BY 1 HAVING count(*) > 1"
)
