"""Intervals against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from medloom.operators.intervals import lag_islands, merge_intervals
from medloom.plans.derive import condition_era, derive, drug_era, observation_period

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(n)


def brute_merge(spans, gap):
    islands = []
    for start, end in sorted(spans):
        if islands and start <= islands[-1][1] + dt.timedelta(gap):
            islands[-1][1] = max(islands[-1][1], end)
        else:
            islands.append([start, end])
    return sorted(map(tuple, islands))


def brute_lag(spans, gap):
    islands, previous = [], None
    for start, end in sorted(spans):
        if previous is None or (start - previous).days > gap:
            islands.append([start, end])
        else:
            islands[-1][1] = max(islands[-1][1], end)
        previous = end
    return {tuple(i) for i in islands}


def random_spans(seed, backwards=False):
    rng = random.Random(seed)
    out = []
    for person in range(40):
        for _ in range(rng.randrange(1, 12)):
            start = rng.randrange(0, 120)
            length = rng.randrange(-90 if backwards else 0, 25)
            out.append((person, day(start), day(start + length)))
    return out


@pytest.mark.parametrize("gap", [0, 3, 30])
def test_merge(spark, gap):
    spans = random_spans(gap)
    df = spark.createDataFrame(spans, "p bigint, s date, e date").groupBy("p", "s").agg(F.max("e").alias("e"))
    got = merge_intervals(df, ["p"], "s", "e", gap, [F.count(F.lit(1)).alias("n")]).collect()
    for person in range(40):
        mine = [(s, e) for p, s, e in spans if p == person]
        islands = sorted((r.island_start, r.island_end) for r in got if r.p == person)
        assert islands == brute_merge(mine, gap)
        for (_, end), (start, _) in zip(islands, islands[1:]):
            assert (start - end).days > gap


@pytest.mark.parametrize("backwards", [False, True])
def test_lag(spark, backwards):
    spans = random_spans(5, backwards)
    got = lag_islands(spark.createDataFrame(spans, "p bigint, s date, e date"), "p", "s", "e", 20).collect()
    for person in range(40):
        mine = [(s, e) for p, s, e in spans if p == person]
        assert {(r.island_start, r.island_end) for r in got if r.p == person} == brute_lag(mine, 20)


def conditions(spark, rows):
    return spark.createDataFrame(
        rows, "person_id bigint, condition_concept_id bigint, condition_start_date date, condition_end_date date")


def test_condition_era_counts_start_dates(spark):
    df = conditions(spark, [(1, 5, day(0), day(2)), (1, 5, day(0), day(4)), (1, 5, day(30), None), (1, 5, day(100), day(90)),
                            (1, 0, day(0), None), (-1, 5, day(0), None), (2, 5, None, day(1))])
    rows = condition_era(df, "s").orderBy("condition_era_start_date").collect()
    assert [(r.condition_era_start_date, r.condition_era_end_date, r.condition_occurrence_count) for r in rows] == [
        (day(0), day(31), 2), (day(100), day(100), 1)]
    assert len({r.condition_era_id for r in rows}) == 2


def test_drug_era_gaps(spark):
    drug = spark.createDataFrame([
        (1, 1, 11, day(0), None, 10), (2, 1, 11, day(5), day(20), None), (3, 1, 12, day(40), None, None),
        (3, 1, 12, day(40), None, None), (4, 1, 11, day(200), None, -3), (5, 1, 0, day(0), None, 3),
    ], "drug_exposure_id bigint, person_id bigint, drug_concept_id bigint, drug_exposure_start_date date,"
       " drug_exposure_end_date date, days_supply bigint")
    concept = spark.createDataFrame([(100, "RxNorm", "Ingredient"), (101, "RxNorm", "Brand"), (102, "ATC", "Ingredient")],
                                    "concept_id bigint, vocabulary_id string, concept_class_id string")
    ancestor = spark.createDataFrame([(100, 11), (100, 12), (101, 11), (102, 11)],
                                     "ancestor_concept_id bigint, descendant_concept_id bigint")
    rows = drug_era(drug, concept, ancestor, "s").orderBy("drug_era_start_date").collect()
    # 0-20 and 40-41 join over 20 days; the repeated id counts once.
    assert [(r.drug_concept_id, r.drug_era_start_date, r.drug_era_end_date, r.drug_exposure_count, r.gap_days)
            for r in rows] == [(100, day(0), day(41), 3, 20), (100, day(200), day(200), 1, 0)]


def test_observation_periods(spark):
    as_of = dt.date(2024, 1, 1)
    person = spark.createDataFrame([(1,), (2,), (3,), (None,)], "person_id bigint")
    visits = spark.createDataFrame([
        (1, dt.date(2015, 1, 1), dt.date(2015, 1, 2)), (1, dt.date(2016, 1, 1), dt.date(2016, 1, 2)),
        (1, dt.date(2020, 1, 1), dt.date(2020, 1, 2)), (2, dt.date(2023, 12, 30), dt.date(2023, 12, 31)),
        (2, dt.date(2030, 1, 1), dt.date(2030, 1, 1)), (2, dt.date(2022, 1, 1), None),
    ], "person_id bigint, visit_start_date date, visit_end_date date")
    death = spark.createDataFrame([(1, dt.date(2016, 1, 1)), (1, dt.date(2016, 2, 1))], "person_id bigint, death_date date")

    def periods(df):
        return sorted((r.person_id, r.observation_period_start_date, r.observation_period_end_date) for r in df.collect())

    whole = (3, dt.date(1970, 1, 1), as_of)
    assert periods(observation_period(person, as_of, "s", visits)) == [
        (1, dt.date(2015, 1, 1), dt.date(2016, 3, 2)), (1, dt.date(2020, 1, 1), dt.date(2020, 3, 2)),
        (2, dt.date(2023, 12, 30), as_of), whole]
    assert periods(observation_period(person, as_of, "s", visits, death)) == [
        (1, dt.date(2015, 1, 1), dt.date(2016, 2, 1)), (2, dt.date(2023, 12, 30), as_of), whole]


def test_dispatch(spark):
    person = spark.createDataFrame([(1,)], "person_id bigint")
    as_of = dt.date(2024, 1, 1)
    assert derive("condition_era", {"person": person}, {}, as_of, "s") is None
    assert derive("observation_period", {"person": person}, {}, as_of, "s").count() == 1
    with pytest.raises(ValueError):
        derive("dose_era", {}, {}, as_of, "s")
