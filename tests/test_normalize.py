import datetime as dt

import pytest

from medloom import schema
from medloom.operators.normalize import globalize_keys, normalize
from medloom.operators.upgrade import populate_source, upgrade
from medloom.operators.validate import name_metrics

RAW = ("condition_occurrence_id string, person_id string, condition_concept_id string, condition_start_date string,"
       " condition_start_datetime string, condition_type_concept_id string, extra string")


def test_rows_split_and_nothing_is_lost(spark):
    rows = [("1", "7", "5", "2024-01-05", "2024-01-05 01:02:03", "32", "x"),
            ("1", None, None, None, None, None, "x"),
            ("1", "seven", "5", "2024-01-05", None, "32", "kept"),
            ("bad", "7", "5", "soon", None, "32", "x"),
            ("2", "7", "5", "soon", "later", "32", "x")]
    result = normalize(spark.createDataFrame(rows, RAW), "condition_occurrence")
    valid = {r.person_id: r for r in result.valid.collect()}
    assert result.valid.columns == schema.layout("condition_occurrence").names
    assert valid[-1].condition_concept_id == 0 and valid[-1].condition_start_date == dt.date(1970, 1, 1)
    assert valid[-1].condition_start_datetime is None and valid[-1].condition_source_concept_id == 0
    invalid = result.invalid.collect()
    assert result.invalid.columns == [c.split()[0] for c in RAW.split(",")]
    assert {(r.person_id, r.condition_occurrence_id, r.extra) for r in invalid} == {("seven", "1", "kept"), ("7", "bad", "x")}
    counts = {r.is_valid: r.row_count for r in result.row_counts().collect()}
    assert counts == {True: 3, False: 2} and sum(counts.values()) == len(rows)


def test_key_is_content(spark):
    df = spark.createDataFrame([("1", "7"), ("2", "7"), ("3", "8")], "measurement_id string, person_id string")
    keys = {r.person_id: r.measurement_id for r in normalize(df, "measurement").valid.collect()}
    assert len(set(keys.values())) == 2 and not {1, 2, 3} & set(keys.values())
    visits = spark.createDataFrame([("1", "7")], "visit_occurrence_id string, person_id string")
    assert normalize(visits, "visit_occurrence").valid.first().visit_occurrence_id == 1


def test_study_id_becomes_the_person(spark):
    df = spark.createDataFrame([("5", "99")], "person_id string, my_Connect_ID_x string")
    assert normalize(df, "death").valid.first().person_id == 99


@pytest.mark.parametrize("given, expected", [
    (("1985-02-03 04:05:06", "1980", "5", "6"), dt.datetime(1985, 2, 3, 4, 5, 6)),
    (("02/03/1985", "1980", "5", "6"), dt.datetime(1980, 5, 6)),
    ((None, "1980", "5", None), dt.datetime(1980, 5, 1)),
    ((None, "1980", None, None), dt.datetime(1980, 1, 1)),
    ((None, None, None, None), dt.datetime(1900, 1, 1)),
    ((None, "1980", "13", "1"), None),
])
def test_birth(spark, given, expected):
    df = spark.createDataFrame([("1", *given)], "person_id string, birth_datetime string, year_of_birth string,"
                               " month_of_birth string, day_of_birth string")
    assert normalize(df, "person").valid.first().birth_datetime == expected


def test_offset_column_needs_no_care(spark):
    df = spark.createDataFrame([("1", "2", "12")], "note_nlp_id string, note_id string, offset string")
    assert normalize(df, "note_nlp").valid.first().offset == "12"


def test_site_keys(spark):
    df = spark.createDataFrame([(1, 2, None)], "person_id bigint, provider_id bigint, location_id bigint")
    row = globalize_keys(df, "person", "s").first()
    assert row.person_id == 1 and row.provider_id != 2 and row.location_id is None
    assert globalize_keys(df, "concept", "s") is df
    assert globalize_keys(df.select("person_id"), "death", "s").first().person_id == 1


def test_upgrade_rules(spark):
    old = spark.createDataFrame([], schema.layout("device_exposure", "5.3"))
    new = upgrade(old, "device_exposure", "5.3", "5.4")
    assert [(f.name, f.dataType) for f in new.schema] == [(f.name, f.dataType) for f in schema.layout("device_exposure")]
    assert upgrade(old, "attribute_definition", "5.3", "5.4") is None
    assert upgrade(old, "person", "5.4", "5.4") is old
    with pytest.raises(ValueError):
        upgrade(old, "person", "5.4", "6.0")


def test_source_row_is_made_or_kept(spark):
    facts = {"cdm_source_name": "n", "cdm_source_abbreviation": "a", "cdm_holder": "h", "source_description": "d",
             "source_release_date": "2023-01-02"}
    day = dt.date(2024, 5, 6)
    given = spark.createDataFrame([("mine", "bad", "2022-02-03"), ("other", None, None)],
                                  "cdm_source_name string, source_release_date string, cdm_release_date string")
    for delivered in (None, given, given.limit(0)):
        row = populate_source(delivered, spark, facts, day, "5.4", "v5").first()
        assert (row.cdm_source_name, row.source_release_date, row.cdm_release_date) == ("n", dt.date(2023, 1, 2), day)
        assert row.cdm_etl_reference == "" and row.cdm_version_concept_id == 756265
    row = populate_source(given.limit(1), spark, facts, day, "5.4", "v5").first()
    assert (row.cdm_source_name, row.source_release_date, row.cdm_release_date) == ("mine", day, dt.date(2022, 2, 3))
    assert row.cdm_holder is None and row.vocabulary_version == "v5"


def test_names():
    assert [m.value_as_string for m in name_metrics("people", ["a"])] == ["invalid table name"]
    found = {m.name: m.value_as_string for m in name_metrics("care_site", ["care_site_id", "nonsense"])}
    assert found["Valid table name: care_site"] == "valid table name"
    assert found["Valid column name: care_site.care_site_id"] == "valid column name"
    assert found["Invalid column name: care_site.nonsense"] == "invalid column name"
    assert found["Missing column: care_site.care_site_name"] == "missing column"
