"""Eras and observation periods.

The checks build eras from start and end events that are counted up and down,
not from running maxima, so that both sides are independent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from casebook.sql import SITE, key
from casebook.views import Views, with_views
from medloom.operators.intervals import lag_islands, merge_intervals
from medloom.plans.derive import condition_era, derive, drug_era, ingredients, observation_period

QUERIES, CHECKS = {}, {}
AS_OF = dt.date(2002, 1, 1)


def _islands(source: str, keys: str, gap: int) -> str:
    """(keys, start, island end) per interval: an island ends where as many intervals ended as began."""
    on = " AND ".join(f"i.{k.strip()} = x.{k.strip()}" for k in keys.split(","))
    return f"""
    SELECT i.*, (SELECT min(x.d) - {gap} FROM (
        SELECT {keys}, d, sum(step) OVER (PARTITION BY {keys} ORDER BY d, step DESC ROWS UNBOUNDED PRECEDING) AS open
        FROM (SELECT {keys}, s AS d, 1 AS step FROM {source} UNION ALL SELECT {keys}, e + {gap}, -1 FROM {source})
      ) x WHERE x.open = 0 AND {on} AND x.d - {gap} >= i.s) AS island_end
    FROM {source} i"""


_CONDITIONS = ("conditions", """
    SELECT person_id, condition_concept_id, condition_start_date AS s,
           coalesce(condition_end_date, condition_start_date + 1) AS e
    FROM f_condition WHERE condition_concept_id <> 0 AND person_id <> -1""")
_ERA_PARTS = ["person_id", "condition_concept_id", "condition_era_start_date", "condition_era_end_date",
              "condition_occurrence_count"]

QUERIES["condition_era"] = lambda v: condition_era(v["f_condition"], SITE)
CHECKS["condition_era"] = with_views(
    f"SELECT {key(_ERA_PARTS, SITE)} AS condition_era_id, {', '.join(_ERA_PARTS)} FROM eras",
    _CONDITIONS,
    ("ends", _islands("conditions", "person_id, condition_concept_id", 30)),
    ("eras", """SELECT person_id, condition_concept_id, min(s) AS condition_era_start_date,
                       island_end AS condition_era_end_date, count(DISTINCT s) AS condition_occurrence_count
                FROM ends GROUP BY person_id, condition_concept_id, island_end"""),
)

_DRUGS = ("drugs", """
    SELECT d.drug_exposure_id, d.person_id, a.ancestor_concept_id AS drug_concept_id, d.drug_exposure_start_date AS s,
           coalesce(d.drug_exposure_end_date, d.drug_exposure_start_date + CAST(d.days_supply AS INTEGER),
                    d.drug_exposure_start_date + 1) AS e
    FROM f_drug d JOIN f_concept_ancestor a ON a.descendant_concept_id = d.drug_concept_id
    JOIN f_drug_concept c ON c.concept_id = a.ancestor_concept_id
    WHERE d.drug_concept_id <> 0 AND d.person_id <> -1 AND c.vocabulary_id = 'RxNorm'
      AND c.concept_class_id = 'Ingredient'""")
_DRUG_PARTS = ["person_id", "drug_concept_id", "drug_era_start_date", "drug_era_end_date", "drug_exposure_count",
               "gap_days"]

QUERIES["drug_ingredients"] = lambda v: ingredients(v["f_drug_concept"], v["f_concept_ancestor"])
CHECKS["drug_ingredients"] = with_views(
    """SELECT descendant_concept_id AS drug_concept_id, ancestor_concept_id AS ingredient_concept_id
       FROM f_concept_ancestor JOIN f_drug_concept ON concept_id = ancestor_concept_id
       WHERE vocabulary_id = 'RxNorm' AND concept_class_id = 'Ingredient'""")

QUERIES["drug_era"] = lambda v: drug_era(v["f_drug"], v["f_drug_concept"], v["f_concept_ancestor"], SITE)
CHECKS["drug_era"] = with_views(
    f"SELECT {key(_DRUG_PARTS, SITE)} AS drug_era_id, {', '.join(_DRUG_PARTS)} FROM eras",
    _DRUGS,
    ("ends", _islands("drugs", "person_id, drug_concept_id", 0)),
    ("subs", """SELECT person_id, drug_concept_id, min(s) AS s, island_end AS e, count(*) AS n
                FROM ends GROUP BY person_id, drug_concept_id, island_end"""),
    ("sub_ends", _islands("subs", "person_id, drug_concept_id", 30)),
    ("eras", """SELECT person_id, drug_concept_id, min(s) AS drug_era_start_date, island_end AS drug_era_end_date,
                       CAST(sum(n) AS BIGINT) AS drug_exposure_count,
                       CAST(island_end - min(s) - sum(e - s) AS BIGINT) AS gap_days
                FROM sub_ends GROUP BY person_id, drug_concept_id, island_end"""),
)

# Overlaps of any interval table: orders of a customer, each open for some days.
_OPEN = ("open_orders", """
    SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS s,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS e FROM orders""")


def _merged_orders(v: Views):
    rows = v.sql(_OPEN[1])
    keys = ["o_custkey", "o_orderpriority"]
    days = rows.groupBy(*keys, "s").agg(F.max("e").alias("e"), F.count(F.lit(1)).alias("n"))
    return merge_intervals(days, keys, "s", "e", 3, [F.sum("n").alias("n")])


QUERIES["merge_intervals"] = _merged_orders
CHECKS["merge_intervals"] = with_views(
    """SELECT o_custkey, o_orderpriority, min(s) AS island_start, island_end, count(*) AS n FROM ends
       GROUP BY o_custkey, o_orderpriority, island_end""",
    _OPEN, ("ends", _islands("open_orders", "o_custkey, o_orderpriority", 3)))


def _lag_sql(rows: str, order: str) -> str:
    return f"""
    SELECT person_id, min(s) AS island_start, max(e) AS island_end
    FROM (SELECT *, sum(opens) OVER (PARTITION BY person_id ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island
          FROM (SELECT *, CASE WHEN p IS NULL OR s - p > 548 THEN 1 ELSE 0 END AS opens
                FROM (SELECT *, lag(e) OVER (PARTITION BY person_id ORDER BY {order}) AS p FROM {rows})))
    GROUP BY person_id, island"""


# Intervals whose end may lie years before their start.
_ODD = ("odd_orders", """
    SELECT o_custkey AS person_id, o_orderkey, DATE '1995-01-01' + CAST(o_orderkey % 9 AS INTEGER) * 300 AS s,
           CAST(o_orderdate AS DATE) AS e FROM orders""")
QUERIES["lag_islands"] = lambda v: lag_islands(v.sql(_ODD[1]), "person_id", "s", "e", 548)
CHECKS["lag_islands"] = with_views(
    # Repeats of one backward interval are one island to us, hence the DISTINCT rows.
    _lag_sql("(SELECT DISTINCT person_id, s, e FROM odd_orders)", "s, e"), _ODD)


def _period_sql(islands: str) -> str:
    parts = ["person_id", "observation_period_start_date", "observation_period_end_date"]
    return f"""
    SELECT {key(parts, SITE)} AS observation_period_id, {', '.join(parts)}, CAST(32882 AS BIGINT) AS period_type_concept_id
    FROM (SELECT DISTINCT person_id, island_start AS observation_period_start_date,
                 island_end AS observation_period_end_date FROM ({islands}))"""


_WHOLE = "SELECT person_id, DATE '1970-01-01' AS island_start, DATE '2002-01-01' AS island_end FROM f_person"
_VISITS = ("visits", """
    SELECT v.person_id, visit_occurrence_id, visit_start_date AS s, visit_end_date AS raw_end,
           least(visit_end_date + 60, DATE '2002-01-01') AS e
    FROM f_visit v WHERE visit_start_date <= DATE '2002-01-01' AND visit_end_date <= DATE '2002-01-01'""")
_VISITS_TO_DEATH = ("visits", """
    SELECT v.person_id, visit_occurrence_id, visit_start_date AS s, visit_end_date AS raw_end,
           least(CASE WHEN death_date < visit_end_date THEN death_date ELSE visit_end_date END + 60,
                 coalesce(death_date, DATE '9999-12-31'), DATE '2002-01-01') AS e
    FROM f_visit v LEFT JOIN f_death d ON d.person_id = v.person_id
    WHERE visit_start_date <= DATE '2002-01-01' AND visit_end_date <= DATE '2002-01-01'
      AND (death_date IS NULL OR death_date >= visit_start_date)""")
_UNSEEN = f"{_WHOLE} WHERE person_id NOT IN (SELECT person_id FROM islands)"
_ORDER = "s, raw_end, visit_occurrence_id"

QUERIES["observation_period_visits"] = lambda v: observation_period(v["f_person"], AS_OF, SITE, v["f_visit"])
CHECKS["observation_period_visits"] = with_views(
    _period_sql(f"SELECT * FROM islands UNION ALL {_UNSEEN}"), _VISITS, ("islands", _lag_sql("visits", _ORDER)))

QUERIES["observation_period_death"] = lambda v: observation_period(
    v["f_person"], AS_OF, SITE, v["f_visit"], v["f_death"])
CHECKS["observation_period_death"] = with_views(
    _period_sql(f"SELECT * FROM islands UNION ALL {_UNSEEN}"),
    _VISITS_TO_DEATH, ("islands", _lag_sql("visits", _ORDER)))

QUERIES["observation_period_person"] = lambda v: observation_period(v["f_person"], AS_OF, SITE)
CHECKS["observation_period_person"] = with_views(_period_sql(_WHOLE))

# The dispatcher picks the form by what was delivered: here no deaths.
QUERIES["derive_observation_period"] = lambda v: derive(
    "observation_period", {"person": v["f_person"], "visit_occurrence": v["f_visit"]}, {}, AS_OF, SITE)
CHECKS["derive_observation_period"] = CHECKS["observation_period_visits"]
