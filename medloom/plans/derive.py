"""Tables derived from a harmonized delivery: eras and observation periods."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import schema
from medloom.functions.casts import whole_number
from medloom.functions.keys import content_key, known_unique
from medloom.operators.intervals import lag_islands, merge_intervals
from medloom.operators.joins import lookup_join

logger = logging.getLogger(__name__)

PERSISTENCE_DAYS = 30
VISIT_PAD_DAYS = 60
VISIT_GAP_DAYS = 548
PERIOD_TYPE = 32882


def _known_person(df: DataFrame) -> Column:
    return F.coalesce(whole_number(df, "person_id"), F.lit(-1)) != -1


def _keyed(df: DataFrame, table: str, parts: list[str], site: str) -> DataFrame:
    """Add the content key and put the columns in the model's order."""
    keyed = df.withColumn(schema.primary_key(table), content_key(parts, site))
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in schema.layout(table)])


def condition_era(condition: DataFrame, site: str) -> DataFrame:
    """Spans of one condition, joined over gaps of up to 30 days.

    The count is of distinct start dates, which is also what rows are reduced
    to before the sort.
    """
    start = F.col("condition_start_date").cast("date")
    end = F.coalesce(F.col("condition_end_date").cast("date"), F.date_add(start, 1))
    days = (
        condition.filter((F.col("condition_concept_id") != 0) & start.isNotNull() & _known_person(condition))
        .groupBy("person_id", "condition_concept_id", start.alias("start"))
        .agg(F.max(F.greatest(start, end)).alias("end"))
    )
    counted = F.count(F.lit(1)).alias("condition_occurrence_count")
    eras = merge_intervals(
        days, ["person_id", "condition_concept_id"], "start", "end", PERSISTENCE_DAYS, [counted]
    ).withColumnsRenamed({"island_start": "condition_era_start_date", "island_end": "condition_era_end_date"})
    return _keyed(eras, "condition_era", schema.layout("condition_era").names[1:], site)


def ingredients(concept: DataFrame, ancestor: DataFrame) -> DataFrame:
    """(drug concept, ingredient) pairs of the drug hierarchy."""
    kind = (F.col("vocabulary_id") == "RxNorm") & (F.col("concept_class_id") == "Ingredient")
    ingredient = concept.filter(kind).select(F.col("concept_id").alias("ingredient_concept_id"))
    pairs = ancestor.select(
        F.col("descendant_concept_id").alias("drug_concept_id"),
        F.col("ancestor_concept_id").alias("ingredient_concept_id"),
    )
    return lookup_join(pairs, ingredient, "ingredient_concept_id", "left_semi")


def drug_era(drug: DataFrame, concept: DataFrame, ancestor: DataFrame, site: str) -> DataFrame:
    """Spans of one ingredient: overlapping exposures first, then gaps of up to 30 days.

    An exposure counts once, however many rows have its id. Where the table is
    known to have unique ids (``keys.known_unique``), rows are counted;
    otherwise rows of one id, ingredient and day are combined first.
    """
    known = drug.filter((F.col("drug_concept_id") != 0) & _known_person(drug))
    start = F.col("drug_exposure_start_date").cast("date")
    end = F.coalesce(
        F.col("drug_exposure_end_date").cast("date"), F.date_add(start, F.col("days_supply").cast("int")),
        F.date_add(start, 1),
    )
    exposures = known.select(
        "drug_exposure_id", "person_id", "drug_concept_id", start.alias("start"), F.greatest(start, end).alias("end")
    ).filter("start IS NOT NULL")
    by_ingredient = lookup_join(exposures, ingredients(concept, ancestor).distinct(), "drug_concept_id", "inner")
    key = ["person_id", "ingredient_concept_id"]
    if not known_unique(drug, "drug_exposure_id"):
        by_ingredient = by_ingredient.groupBy(*key, "start", "drug_exposure_id").agg(F.max("end").alias("end"))
    # One row a day, however many exposures start on it.
    days = by_ingredient.groupBy(*key, "start").agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("exposures"))
    overlaps = merge_intervals(days, key, "start", "end", 0, [F.sum("exposures").alias("exposures")])
    spans = overlaps.select(
        *key, F.col("island_start").alias("start"), F.col("island_end").alias("end"), "exposures",
        F.datediff("island_end", "island_start").alias("exposed"),
    )
    eras = merge_intervals(spans, key, "start", "end", PERSISTENCE_DAYS, [
        F.sum("exposures").alias("drug_exposure_count"), F.sum("exposed").alias("exposed"),
    ])
    named = eras.select(
        "person_id", F.col("ingredient_concept_id").alias("drug_concept_id"),
        F.col("island_start").alias("drug_era_start_date"), F.col("island_end").alias("drug_era_end_date"),
        "drug_exposure_count", (F.datediff("island_end", "island_start") - F.col("exposed")).alias("gap_days"),
    )
    return _keyed(named, "drug_era", schema.layout("drug_era").names[1:], site)


def observation_period(
    person: DataFrame, as_of: dt.date, site: str, visits: DataFrame | None = None, death: DataFrame | None = None,
) -> DataFrame:
    """Time each person was under observation.

    From visits, cut at death if known; people without visits, or everybody if
    no visits were delivered, count from the placeholder date until ``as_of``.
    """
    whole = [F.lit(schema.DEFAULTS["date"]).cast("date").alias("island_start"), F.lit(as_of).alias("island_end")]
    if visits is None:
        periods = person.select("person_id", *whole).distinct()
    else:
        islands = _visit_islands(visits, death, as_of)
        seen = islands.select("person_id").distinct()
        unseen = person.filter(F.col("person_id").isNotNull()).select("person_id").distinct()
        periods = islands.unionByName(unseen.join(seen, "person_id", "left_anti").select("person_id", *whole)).distinct()
    named = periods.select(
        "person_id", F.col("island_start").alias("observation_period_start_date"),
        F.col("island_end").alias("observation_period_end_date"), F.lit(PERIOD_TYPE).alias("period_type_concept_id"),
    )
    parts = ["person_id", "observation_period_start_date", "observation_period_end_date"]
    return _keyed(named, "observation_period", parts, site)


def _visit_islands(visits: DataFrame, death: DataFrame | None, as_of: dt.date) -> DataFrame:
    today = F.lit(as_of)
    start, end = F.col("visit_start_date").cast("date"), F.col("visit_end_date").cast("date")
    rows = visits.filter((start <= today) & (end <= today) & _known_person(visits)).select(
        "person_id", start.alias("start"), end.alias("end")
    )
    if death is None:
        padded = F.least(F.date_add("end", VISIT_PAD_DAYS), today)
    else:
        died = death.filter(F.col("death_date").cast("date").isNotNull() & _known_person(death)).select(
            "person_id", F.col("death_date").cast("date").alias("died")
        ).distinct()
        # Distinct spans first: that bounds what one person brings to the join.
        rows = rows.distinct().join(died, "person_id", "left").filter(
            F.col("died").isNull() | (F.col("died") >= F.col("start"))
        )
        padded = F.least(F.date_add(F.least("end", "died"), VISIT_PAD_DAYS), F.col("died"), today)
    return lag_islands(rows.withColumn("end", padded), "person_id", "start", "end", VISIT_GAP_DAYS)


def derive(
    name: str, delivery: dict[str, DataFrame], vocabulary: dict[str, DataFrame], as_of: dt.date, site: str,
) -> DataFrame | None:
    """A derived table by name, or None if the delivery lacks what it needs."""
    if name not in schema.DERIVED_TABLES:
        raise ValueError(f"{name} is not a derived table")
    missing = [t for t in schema.DERIVED_TABLES[name] if t not in delivery]
    if missing:
        logger.warning("cannot derive %s without %s", name, ", ".join(missing))
        return None
    if name == "condition_era":
        return condition_era(delivery["condition_occurrence"], site)
    if name == "drug_era":
        return drug_era(delivery["drug_exposure"], vocabulary["concept"], vocabulary["concept_ancestor"], site)
    visits = delivery.get("visit_occurrence")
    death = delivery.get("death") if visits is not None else None
    return observation_period(delivery["person"], as_of, site, visits, death)
