"""Clinical tables seen in the given tables.

The same text runs in Spark and in DuckDB: the queries read the views as
frames, the checks inline them as leading WITH entries. Only the id of a line
is put otherwise in Spark, where it may be past the range of a long.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

# An id that is unique among lineitem rows.
_LINE_ID = ("((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000000 + l_suppkey * 100"
            " + CAST(l_quantity AS BIGINT)")
# The same id in Spark: past the range of a long (order keys above 9,223,371) its low 64 bits, by steps that stay in range.
# It is the same number wherever that fits a long; beyond, the text above has no value but ends the query.
_LINE = "(l_orderkey * 10 + l_linenumber)"
_LOW = (f"(({_LINE} & 16777215) * 100000000000 + l_partkey * 1000000 + l_suppkey * 100"
        " + CAST(l_quantity AS BIGINT))")
_LINE_ID_IN_RANGE = (f"(shiftleft(shiftright({_LINE}, 24) * 100000000000 + shiftright({_LOW}, 24), 24)"
                     f" + ({_LOW} & 16777215))")
_SHIP_TEXT = "CAST(CAST(l_shipdate AS DATE) AS STRING)"

VIEWS = {
    "f_person": """
SELECT c_custkey AS person_id, 8507 + (c_custkey % 2) * 25 AS gender_concept_id, 1930 + c_custkey % 70 AS year_of_birth,
       CAST(c_nationkey AS BIGINT) AS location_id, c_custkey % 20 AS provider_id
FROM customer WHERE c_custkey % 90 <> 7""",
    "f_registry": """
SELECT CAST(c_custkey AS STRING) AS connect_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '875007964' WHEN c_custkey % 33 = 2 THEN NULL ELSE '197316935' END AS verified_status_concept_id,
       CASE WHEN c_custkey % 25 = 1 THEN '353358909' ELSE '104430631' END AS consent_withdrawn_concept_id,
       CASE WHEN c_custkey % 45 = 3 THEN '353358909' ELSE '104430631' END AS hipaa_revoked_concept_id,
       CASE WHEN c_custkey % 55 = 4 THEN '353358909' ELSE '104430631' END AS data_destruction_requested_concept_id
FROM customer WHERE c_custkey % 40 <> 0""",
    "f_death": """
SELECT c_custkey AS person_id, DATE '1999-01-01' + CAST(c_custkey % 700 AS INT) AS death_date
FROM customer WHERE c_custkey % 37 = 5""",
    "f_visit": """
SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id, 9201 AS visit_concept_id,
       CAST(o_orderdate AS DATE) AS visit_start_date,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT) END AS visit_end_date
FROM orders""",
    "f_concept": """
SELECT p_partkey AS concept_id, p_name AS concept_name,
       CASE p_partkey % 10 WHEN 0 THEN 'Condition' WHEN 4 THEN 'Procedure' WHEN 5 THEN 'Device' WHEN 6 THEN 'Measurement'
            WHEN 7 THEN 'Observation' WHEN 8 THEN 'Meas Value' WHEN 9 THEN 'Geography' ELSE 'Drug' END AS domain_id,
       p_brand AS vocabulary_id, CASE WHEN p_partkey % 5 = 0 THEN 'Ingredient' ELSE 'Clinical Drug' END AS concept_class_id,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'S' END AS standard_concept
FROM part""",
    "f_drug_concept": """
SELECT p_partkey AS concept_id, CASE WHEN p_partkey % 15 = 0 THEN 'ATC' ELSE 'RxNorm' END AS vocabulary_id,
       CASE WHEN p_partkey % 5 = 0 THEN 'Ingredient' ELSE 'Clinical Drug' END AS concept_class_id
FROM part""",
    "f_concept_relationship": """
SELECT p_partkey AS concept_id_1, p_partkey + 1 AS concept_id_2, 'Maps to' AS relationship_id FROM part WHERE p_partkey > 0 AND p_partkey % 4 = 0 AND p_partkey % 16 <> 0
UNION ALL SELECT p_partkey, p_partkey + 3, 'Maps to' FROM part WHERE p_partkey > 0 AND p_partkey % 12 = 0
UNION ALL SELECT p_partkey, p_partkey + 2, 'Maps to value' FROM part WHERE p_partkey > 0 AND p_partkey % 20 = 0
UNION ALL SELECT p_partkey, p_partkey + 5, 'Concept replaced by' FROM part WHERE p_partkey > 0 AND p_partkey % 8 = 0
UNION ALL SELECT p_partkey, p_partkey + 7, 'Is a' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, p_partkey, 'Maps to' FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 7 <> 0""",
    "f_concept_ancestor": """
SELECT p_partkey - p_partkey % 5 AS ancestor_concept_id, p_partkey AS descendant_concept_id FROM part""",
    "f_drug": f"""
SELECT {_LINE_ID} AS drug_exposure_id,
       l_orderkey * 10 + l_linenumber AS dup_key, o_custkey AS person_id,
       CASE WHEN l_linenumber = 3 THEN 0 ELSE l_partkey END AS drug_concept_id,
       CASE WHEN l_linenumber = 1 THEN l_partkey - l_partkey % 4 WHEN l_linenumber = 2 THEN 0 ELSE l_partkey END AS drug_source_concept_id,
       CAST(32800 + l_linenumber AS BIGINT) AS drug_type_concept_id,
       CAST(l_shipdate AS DATE) AS drug_exposure_start_date,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) ELSE NULL END AS drug_exposure_end_date,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS days_supply,
       l_orderkey AS visit_occurrence_id, l_returnflag AS drug_source_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "f_condition": """
SELECT event_id AS condition_occurrence_id, user_id AS person_id,
       CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 10 WHEN 'purchase' THEN 20 WHEN 'view' THEN 30 ELSE 40 END AS BIGINT) AS condition_concept_id,
       CAST(ts AS DATE) + CAST((event_id % 13) * 45 AS INT) AS condition_start_date,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(ts AS DATE) + CAST((event_id % 13) * 45 + event_id % 9 AS INT) END AS condition_end_date
FROM events""",
    # A finding with its source code and status, for moves out of the condition table.
    "f_finding": """
SELECT event_id AS condition_occurrence_id, user_id AS person_id, event_id % 1999 AS condition_concept_id,
       CASE WHEN event_id % 3 = 0 THEN 0 ELSE (event_id * 7) % 1999 END AS condition_source_concept_id,
       CAST(ts AS DATE) AS condition_start_date,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(ts AS DATE) + CAST(event_id % 9 AS INT) END AS condition_end_date,
       CAST(32800 + event_id % 5 AS BIGINT) AS condition_type_concept_id, event_id % 100 AS visit_occurrence_id,
       event_type AS condition_source_value, event_type AS condition_status_source_value,
       event_id % 50 AS condition_status_concept_id
FROM events""",
    "f_measurement": f"""
SELECT {_LINE_ID} AS measurement_id, o_custkey AS person_id,
       CASE l_linenumber WHEN 1 THEN 4020553 WHEN 2 THEN 3020891 WHEN 3 THEN 0 ELSE l_partkey END AS measurement_concept_id,
       CASE WHEN l_partkey % 3 = 0 THEN 0 WHEN l_partkey % 31 = 0 THEN NULL ELSE l_partkey END AS measurement_source_concept_id,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 2 = 0 THEN concat('glucose ', l_returnflag) ELSE concat('hb', l_linestatus) END AS measurement_source_value,
       CASE WHEN l_linenumber = 7 THEN DATE '1970-01-01' ELSE CAST(l_shipdate AS DATE) END AS measurement_date,
       CAST(32800 + l_linenumber AS BIGINT) AS measurement_type_concept_id,
       CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE l_suppkey END AS unit_concept_id,
       CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE l_partkey + (l_linenumber % 3) * 1000 END AS unit_source_concept_id,
       l_linestatus AS unit_source_value, l_suppkey AS value_as_concept_id, l_orderkey AS measurement_event_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "f_raw_drug": f"""
SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'abc' WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS person_id,
       CASE WHEN l_partkey % 53 = 0 THEN '12.7' WHEN l_partkey % 59 = 0 THEN 'NULL' ELSE CAST(l_partkey AS STRING) END AS drug_concept_id,
       CASE WHEN l_linenumber = 1 THEN concat(substr({_SHIP_TEXT}, 6, 2), '/', substr({_SHIP_TEXT}, 9, 2), '/', substr({_SHIP_TEXT}, 1, 4))
            WHEN l_linenumber = 2 THEN 'not a date' ELSE {_SHIP_TEXT} END AS drug_exposure_start_date,
       CAST(CAST(l_quantity AS BIGINT) AS STRING) AS quantity, 'x' AS not_in_schema
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "f_raw_person": """
SELECT CAST(c_custkey AS STRING) AS person_id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(1930 + c_custkey % 70 AS STRING) END AS year_of_birth,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(1 + c_custkey % 13 AS STRING) END AS month_of_birth,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(1 + c_custkey % 28 AS STRING) END AS day_of_birth,
       CASE c_custkey % 4 WHEN 0 THEN '1985-02-03 04:05:06' WHEN 1 THEN '1985/2/3' WHEN 2 THEN 'unknown' ELSE NULL END AS birth_datetime
FROM customer""",
    # Registry rows as exported: coded variables; some people appear twice.
    "f_participants": """
SELECT CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS connect_id, c_mktsegment AS site,
       CASE c_custkey % 7 WHEN 0 THEN '197316935' WHEN 1 THEN '875007964' WHEN 2 THEN '290379732' WHEN 3 THEN '160161595'
            WHEN 4 THEN '922622075' WHEN 5 THEN '219863910' ELSE '1' END AS d_821247024,
       CASE WHEN c_custkey % 3 = 0 THEN '353358909' ELSE '104430631' END AS d_747006172,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '104430631' END AS d_773707518,
       CASE WHEN c_custkey % 6 = 0 THEN '353358909' ELSE '104430631' END AS d_831041022,
       CASE c_custkey % 4 WHEN 0 THEN '972455046' WHEN 1 THEN '615768760' WHEN 2 THEN '231311385' END AS d_949302066,
       CASE WHEN c_custkey % 2 = 0 THEN '231311385' ELSE '353358909' END AS d_536735468,
       '972455046' AS d_976570371, CAST(c_nationkey AS STRING) AS d_663265240, CAST(NULL AS STRING) AS d_459098666,
       '615768760' AS d_220186468, '231311385' AS d_956490759,
       concat('2024-01-', CAST(10 + c_custkey % 20 AS STRING)) AS d_659990606, CAST(NULL AS STRING) AS d_664453818, CAST(NULL AS STRING) AS d_269050420,
       CAST(c_nationkey AS STRING) AS d_517311251, CAST(NULL AS STRING) AS d_832139544, CAST(NULL AS STRING) AS d_770257102, CAST(NULL AS STRING) AS d_264644252,
       CAST(NULL AS STRING) AS d_217640691, CAST(NULL AS STRING) AS d_784810139, CAST(NULL AS STRING) AS d_199471989
FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 2 = 1) c""",
    # A run log with one row per site and day, and updates to it.
    "f_log": """
SELECT concat('site ', CAST(o_custkey % 50 AS STRING)) AS site_name, CAST(o_orderdate AS DATE) AS delivery_date,
       CASE min(o_orderkey) % 4 WHEN 0 THEN 'started' WHEN 1 THEN 'running' WHEN 2 THEN 'completed' ELSE 'error' END AS status,
       CASE WHEN min(o_orderkey) % 8 = 3 THEN 'no such file' WHEN min(o_orderkey) % 8 = 7 THEN '' ELSE NULL END AS message,
       concat('run ', CAST(min(o_orderkey) AS STRING)) AS run_id
FROM orders GROUP BY 1, 2""",
    "f_log_starts": """
SELECT concat('site ', CAST(o_custkey % 50 AS STRING)) AS site_name, CAST(o_orderdate AS DATE) + 1 AS delivery_date,
       concat('rerun ', CAST(min(o_orderkey) AS STRING)) AS run_id
FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1, 2""",
}

_NEEDS = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)", re.IGNORECASE)


# Table layouts by path, so that each is read from the files once.
_LAYOUTS: dict[str, StructType] = {}


class Views:
    """Given tables and views as frames; each is opened when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread: bool = False):
        self.spark, self.sf_dir, self._spread = spark, sf_dir, spread
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.sql(VIEWS[name].replace(_LINE_ID, _LINE_ID_IN_RANGE)) if name in VIEWS else self._table(name)
        return self._frames[name]

    def _table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _LAYOUTS:
            _LAYOUTS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_LAYOUTS[path]).parquet(path)
        # One file may be one row group, which one task reads however the file
        # is split. Costly row work spreads such a table first; a table of many
        # files, or one too small to split, stays as it is.
        slots = self.spark.sparkContext.defaultParallelism
        return df.repartition(slots) if self._spread and 1 < df.rdd.getNumPartitions() < slots else df

    def sql(self, text: str) -> DataFrame:
        for name in set(_NEEDS.findall(text)):
            if name in VIEWS or name in TABLES:
                self[name].createOrReplaceTempView(name)
        return self.spark.sql(text)


def with_views(query: str, *entries: tuple[str, str]) -> str:
    """A DuckDB query with its own WITH entries and the views they need in front."""
    needed: dict[str, str] = {}

    def collect(text: str) -> None:
        for name in _NEEDS.findall(text):
            if name in VIEWS and name not in needed:
                collect(VIEWS[name])
                needed[name] = VIEWS[name]

    for text in [*[body for _, body in entries], query]:
        collect(text)
    parts = [f"{name} AS ({body})" for name, body in [*needed.items(), *entries]]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + query
