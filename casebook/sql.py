"""Text pieces of the DuckDB checks."""

from __future__ import annotations

SITE = "site_a"
# Fixed values of the model: the table a domain belongs to.
_TABLE_OF = {
    "Visit": "visit_occurrence", "Condition": "condition_occurrence", "Drug": "drug_exposure",
    "Procedure": "procedure_occurrence", "Device": "device_exposure", "Measurement": "measurement",
    "Observation": "observation", "Note": "note", "Specimen": "specimen",
}

Entry = tuple[str, str]


def key(parts: list[str], salt: str | None = None) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts] + ([f"'{salt}'"] if salt is not None else [])
    return f"CAST('0x' || substr(md5(concat_ws(chr(31), {', '.join(texts)})), 1, 15) AS BIGINT)"


def digest(parts: list[str]) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + "))"


def table_case(domain: str, own: str) -> str:
    whens = " ".join(f"WHEN '{d}' THEN '{t}'" for d, t in _TABLE_OF.items())
    return f"CASE {domain} {whens} ELSE '{own}' END"


VOCAB: Entry = ("vocab", """
    SELECT DISTINCT c.concept_id, c.standard_concept AS concept_id_standard, c.domain_id AS concept_id_domain,
           r.relationship_id, r.concept_id_2 AS target_concept_id, t.standard_concept AS target_concept_id_standard,
           t.domain_id AS target_concept_id_domain
    FROM f_concept c
    LEFT JOIN f_concept_relationship r
      ON r.concept_id_1 = c.concept_id AND r.relationship_id IN ('Maps to', 'Maps to value', 'Concept replaced by')
    LEFT JOIN f_concept t ON t.concept_id = r.concept_id_2""")
DOMAINS: Entry = ("domains", "SELECT DISTINCT concept_id, concept_id_domain AS domain FROM vocab")


def _recode(view: str, columns: list[str], key_column: str, target: str, source: str, status: str, relations: str,
            on: str, settled: list[str]) -> str:
    """Rows of one mapping step: joined on the source or the target concept."""
    changed = {target: "v.target_concept_id"}
    if on == target:
        changed[source] = f"t.{target}"
    listed = ", ".join(f"{changed.get(c, 't.' + c)} AS {c}" for c in columns)
    later = "".join(f" AND t.{key_column} NOT IN (SELECT {key_column} FROM {s})" for s in settled)
    nonzero = f" AND t.{source} <> 0" if on == source else ""
    return f"""
    SELECT {listed}, v.target_concept_id_domain AS target_domain, '{status}' AS vocab_harmonization_status,
           t.{source} AS source_concept_id, t.{target} AS previous_target_concept_id, v.target_concept_id,
           v.relationship_id AS mapping_relationship_id, w.top AS vh_value_as_concept_id
    FROM {view} t JOIN vocab v ON v.concept_id = t.{on}
    LEFT JOIN (SELECT x.{key_column}, max(y.target_concept_id) AS top FROM {view} x JOIN vocab y ON y.concept_id = x.{on}
               WHERE y.target_concept_id_domain = 'Meas Value' OR y.relationship_id = 'Maps to value'
               GROUP BY 1) w ON w.{key_column} = t.{key_column}
    WHERE v.relationship_id IN ({relations}) AND v.relationship_id <> 'Maps to value'
      AND v.target_concept_id_standard = 'S' AND coalesce(v.target_concept_id_domain, '') <> 'Meas Value'
      AND v.target_concept_id <> t.{target}{nonzero}{later}"""


def chain(view: str, columns: list[str], key_column: str, target: str, source: str, table: str,
          replacement: bool = False) -> list[Entry]:
    """The whole harmonization, step by step, each excluding the keys of those before."""
    args = (view, columns, key_column, target, source)
    maps = "'Maps to', 'Maps to value'"
    entries = [VOCAB, DOMAINS]
    steps = ["step_source"]
    entries.append(("step_source", _recode(*args, "source_concept_id mapped to new target", maps, source, [])))
    entries.append(("step_target", _recode(
        *args, "existing non-standard target remapped to standard code", maps, target, steps)))
    steps = [*steps, "step_target"]
    if replacement:
        entries.append(("step_replace", _recode(
            *args, "existing non-standard target replaced with standard code", "'Concept replaced by'", target, steps)))
        steps = [*steps, "step_replace"]

    def settle(status: str, code: str, condition: str, earlier: list[str], replaced: dict[str, str]) -> str:
        listed = ", ".join(f"{replaced.get(c, 't.' + c)} AS {c}" for c in columns)
        later = "".join(f" AND t.{key_column} NOT IN (SELECT {key_column} FROM {s})" for s in earlier)
        return f"""
    SELECT {listed}, coalesce(d.domain, 'Unknown') AS target_domain, '{status}' AS vocab_harmonization_status,
           t.{source} AS source_concept_id, t.{target} AS previous_target_concept_id, t.{code} AS target_concept_id,
           CAST(NULL AS VARCHAR) AS mapping_relationship_id, CAST(NULL AS BIGINT) AS vh_value_as_concept_id
    FROM {view} t LEFT JOIN domains d ON d.concept_id = t.{code} WHERE {condition}{later}"""

    fill = f"t.{target} = 0 AND t.{source} <> 0 AND d.concept_id IS NOT NULL"
    entries.append(("step_fill", settle("source_concept_id backfill", source, fill, steps, {target: f"t.{source}"})))
    steps = [*steps, "step_fill"]
    entries.append(("step_domain", settle("domain check", target, "TRUE", steps, {})))
    union = " UNION ALL ".join(f"SELECT * FROM {s}" for s in [*steps, "step_domain"])
    entries.append(("harmonized", f"SELECT *, {table_case('target_domain', table)} AS target_table FROM ({union})"))
    return entries
