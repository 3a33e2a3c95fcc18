import pytest

from medloom import schema


def test_types_follow_names():
    kinds = {f.name: f.dataType.simpleString() for f in schema.layout("drug_exposure")}
    assert kinds["drug_exposure_id"] == "bigint" and kinds["quantity"] == "double"
    assert kinds["drug_exposure_start_date"] == "date" and kinds["drug_exposure_start_datetime"] == "timestamp_ntz"
    assert kinds["sig"] == "string"
    assert {f.name: f.dataType.simpleString() for f in schema.layout("procedure_occurrence")}["quantity"] == "bigint"
    assert {f.name: f.dataType.simpleString() for f in schema.layout("device_exposure")}["unique_device_id"] == "string"


def test_keys_and_required():
    assert schema.primary_key("measurement") == "measurement_id"
    assert schema.primary_key("death") is None
    required = [f.name for f in schema.layout("measurement") if f.metadata["required"]]
    assert required == ["measurement_id", "person_id", "measurement_concept_id", "measurement_date",
                        "measurement_type_concept_id"]


def test_versions_differ_as_published():
    old = schema.layout("visit_detail", "5.3").names
    assert "visit_detail_parent_id" in old and "parent_visit_detail_id" not in old
    assert "production_id" not in schema.layout("device_exposure", "5.3").names
    assert "attribute_definition" in schema.tables("5.3") and "attribute_definition" not in schema.tables("5.4")
    assert "episode" not in schema.tables("5.3")
    with pytest.raises(ValueError):
        schema.tables("6.0")


def test_pairs():
    assert schema.concept_pairs("measurement") == [
        ("measurement_concept_id", "measurement_source_concept_id"), ("unit_concept_id", "unit_source_concept_id")]
    assert schema.primary_pair("note") == ("note_class_concept_id", None)


def test_every_table_has_one_kind_of_key():
    both = set(schema.SURROGATE_KEY_TABLES) & set(schema.NATURAL_KEY_TABLES)
    assert not both
    for table in [*schema.SURROGATE_KEY_TABLES, *schema.NATURAL_KEY_TABLES]:
        assert schema.primary_key(table) == schema.layout(table).names[0]
