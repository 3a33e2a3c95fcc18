"""Table layouts of the clinical data model, versions 5.3 and 5.4.

Layouts follow the published model. A name ending in ``!`` is required;
the first column of a keyed table is its primary key. Types follow from
names by :func:`column_type`.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

VERSION_CONCEPTS = {"5.3": 1147543, "5.4": 756265}


# Fixed values of the published model, version 5.4: the columns of each table in their order.
_LAYOUTS = {
    "person": """
        person_id! gender_concept_id! year_of_birth! month_of_birth day_of_birth birth_datetime race_concept_id!
        ethnicity_concept_id! location_id provider_id care_site_id person_source_value gender_source_value
        gender_source_concept_id race_source_value race_source_concept_id ethnicity_source_value
        ethnicity_source_concept_id""",
    "observation_period": """
        observation_period_id! person_id! observation_period_start_date! observation_period_end_date!
        period_type_concept_id!""",
    "visit_occurrence": """
        visit_occurrence_id! person_id! visit_concept_id! visit_start_date! visit_start_datetime visit_end_date!
        visit_end_datetime visit_type_concept_id! provider_id care_site_id visit_source_value
        visit_source_concept_id admitted_from_concept_id admitted_from_source_value discharged_to_concept_id
        discharged_to_source_value preceding_visit_occurrence_id""",
    "visit_detail": """
        visit_detail_id! person_id! visit_detail_concept_id! visit_detail_start_date! visit_detail_start_datetime
        visit_detail_end_date! visit_detail_end_datetime visit_detail_type_concept_id! provider_id care_site_id
        visit_detail_source_value visit_detail_source_concept_id admitted_from_concept_id admitted_from_source_value
        discharged_to_source_value discharged_to_concept_id preceding_visit_detail_id parent_visit_detail_id
        visit_occurrence_id!""",
    "condition_occurrence": """
        condition_occurrence_id! person_id! condition_concept_id! condition_start_date! condition_start_datetime
        condition_end_date condition_end_datetime condition_type_concept_id! condition_status_concept_id stop_reason
        provider_id visit_occurrence_id visit_detail_id condition_source_value condition_source_concept_id
        condition_status_source_value""",
    "drug_exposure": """
        drug_exposure_id! person_id! drug_concept_id! drug_exposure_start_date! drug_exposure_start_datetime
        drug_exposure_end_date! drug_exposure_end_datetime verbatim_end_date drug_type_concept_id! stop_reason
        refills quantity:double days_supply sig route_concept_id lot_number provider_id visit_occurrence_id
        visit_detail_id drug_source_value drug_source_concept_id route_source_value dose_unit_source_value""",
    "procedure_occurrence": """
        procedure_occurrence_id! person_id! procedure_concept_id! procedure_date! procedure_datetime
        procedure_end_date procedure_end_datetime procedure_type_concept_id! modifier_concept_id quantity
        provider_id visit_occurrence_id visit_detail_id procedure_source_value procedure_source_concept_id
        modifier_source_value""",
    "device_exposure": """
        device_exposure_id! person_id! device_concept_id! device_exposure_start_date! device_exposure_start_datetime
        device_exposure_end_date device_exposure_end_datetime device_type_concept_id! unique_device_id production_id
        quantity provider_id visit_occurrence_id visit_detail_id device_source_value device_source_concept_id
        unit_concept_id unit_source_value unit_source_concept_id""",
    "measurement": """
        measurement_id! person_id! measurement_concept_id! measurement_date! measurement_datetime measurement_time
        measurement_type_concept_id! operator_concept_id value_as_number value_as_concept_id unit_concept_id
        range_low range_high provider_id visit_occurrence_id visit_detail_id measurement_source_value
        measurement_source_concept_id unit_source_value unit_source_concept_id value_source_value
        measurement_event_id meas_event_field_concept_id""",
    "observation": """
        observation_id! person_id! observation_concept_id! observation_date! observation_datetime
        observation_type_concept_id! value_as_number value_as_string value_as_concept_id qualifier_concept_id
        unit_concept_id provider_id visit_occurrence_id visit_detail_id observation_source_value
        observation_source_concept_id unit_source_value qualifier_source_value value_source_value
        observation_event_id obs_event_field_concept_id""",
    "death": """
        person_id! death_date! death_datetime death_type_concept_id cause_concept_id cause_source_value
        cause_source_concept_id""",
    "note": """
        note_id! person_id! note_date! note_datetime note_type_concept_id! note_class_concept_id! note_title
        note_text! encoding_concept_id! language_concept_id! provider_id visit_occurrence_id visit_detail_id
        note_source_value note_event_id note_event_field_concept_id""",
    "note_nlp": """
        note_nlp_id! note_id! section_concept_id snippet offset lexical_variant! note_nlp_concept_id
        note_nlp_source_concept_id nlp_system nlp_date! nlp_datetime term_exists term_temporal term_modifiers""",
    "specimen": """
        specimen_id! person_id! specimen_concept_id! specimen_type_concept_id! specimen_date! specimen_datetime
        quantity:double unit_concept_id anatomic_site_concept_id disease_status_concept_id specimen_source_id
        specimen_source_value unit_source_value anatomic_site_source_value disease_status_source_value""",
    "fact_relationship": """
        domain_concept_id_1! fact_id_1! domain_concept_id_2! fact_id_2! relationship_concept_id!""",
    "location": """
        location_id! address_1 address_2 city state zip county location_source_value country_concept_id
        country_source_value latitude longitude""",
    "care_site": """
        care_site_id! care_site_name place_of_service_concept_id location_id care_site_source_value
        place_of_service_source_value""",
    "provider": """
        provider_id! provider_name npi dea specialty_concept_id care_site_id year_of_birth gender_concept_id
        provider_source_value specialty_source_value specialty_source_concept_id gender_source_value
        gender_source_concept_id""",
    "payer_plan_period": """
        payer_plan_period_id! person_id! payer_plan_period_start_date! payer_plan_period_end_date! payer_concept_id
        payer_source_value payer_source_concept_id plan_concept_id plan_source_value plan_source_concept_id
        sponsor_concept_id sponsor_source_value sponsor_source_concept_id family_source_value stop_reason_concept_id
        stop_reason_source_value stop_reason_source_concept_id""",
    "cost": """
        cost_id! cost_event_id! cost_domain_id! cost_type_concept_id! currency_concept_id total_charge total_cost
        total_paid paid_by_payer paid_by_patient paid_patient_copay paid_patient_coinsurance paid_patient_deductible
        paid_by_primary paid_ingredient_cost paid_dispensing_fee payer_plan_period_id amount_allowed
        revenue_code_concept_id revenue_code_source_value drg_concept_id drg_source_value""",
    "drug_era": """
        drug_era_id! person_id! drug_concept_id! drug_era_start_date! drug_era_end_date! drug_exposure_count
        gap_days""",
    "dose_era": """
        dose_era_id! person_id! drug_concept_id! unit_concept_id! dose_value! dose_era_start_date!
        dose_era_end_date!""",
    "condition_era": """
        condition_era_id! person_id! condition_concept_id! condition_era_start_date! condition_era_end_date!
        condition_occurrence_count""",
    "episode": """
        episode_id! person_id! episode_concept_id! episode_start_date! episode_start_datetime episode_end_date
        episode_end_datetime episode_parent_id episode_number episode_object_concept_id! episode_type_concept_id!
        episode_source_value episode_source_concept_id""",
    "episode_event": """
        episode_id! event_id! episode_event_field_concept_id!""",
    "metadata": """
        metadata_id! metadata_concept_id! metadata_type_concept_id! name! value_as_string value_as_concept_id
        value_as_number metadata_date metadata_datetime""",
    "cdm_source": """
        cdm_source_name! cdm_source_abbreviation! cdm_holder! source_description source_documentation_reference
        cdm_etl_reference source_release_date! cdm_release_date! cdm_version cdm_version_concept_id!
        vocabulary_version!""",
    "concept": """
        concept_id! concept_name! domain_id! vocabulary_id! concept_class_id! standard_concept concept_code!
        valid_start_date! valid_end_date! invalid_reason""",
    "vocabulary": """
        vocabulary_id! vocabulary_name! vocabulary_reference vocabulary_version vocabulary_concept_id!""",
    "domain": """
        domain_id! domain_name! domain_concept_id!""",
    "concept_class": """
        concept_class_id! concept_class_name! concept_class_concept_id!""",
    "concept_relationship": """
        concept_id_1! concept_id_2! relationship_id! valid_start_date! valid_end_date! invalid_reason""",
    "relationship": """
        relationship_id! relationship_name! is_hierarchical! defines_ancestry! reverse_relationship_id!
        relationship_concept_id!""",
    "concept_synonym": """
        concept_id! concept_synonym_name! language_concept_id!""",
    "concept_ancestor": """
        ancestor_concept_id! descendant_concept_id! min_levels_of_separation! max_levels_of_separation!""",
    "source_to_concept_map": """
        source_code! source_concept_id! source_vocabulary_id! source_code_description target_concept_id!
        target_vocabulary_id! valid_start_date! valid_end_date! invalid_reason""",
    "drug_strength": """
        drug_concept_id! ingredient_concept_id! amount_value amount_unit_concept_id numerator_value
        numerator_unit_concept_id denominator_value denominator_unit_concept_id box_size valid_start_date!
        valid_end_date! invalid_reason""",
    "cohort": """
        cohort_definition_id! subject_id! cohort_start_date! cohort_end_date!""",
    "cohort_definition": """
        cohort_definition_id! cohort_definition_name! cohort_definition_description definition_type_concept_id!
        cohort_definition_syntax subject_concept_id! cohort_initiation_date""",
}

# Fixed values of the published model, version 5.3: tables whose columns differ, and one that 5.4 dropped.
_LAYOUTS_53 = {
    "visit_occurrence": """
        visit_occurrence_id! person_id! visit_concept_id! visit_start_date! visit_start_datetime visit_end_date!
        visit_end_datetime visit_type_concept_id! provider_id care_site_id visit_source_value
        visit_source_concept_id admitting_source_concept_id admitting_source_value discharge_to_concept_id
        discharge_to_source_value preceding_visit_occurrence_id""",
    "visit_detail": """
        visit_detail_id! person_id! visit_detail_concept_id! visit_detail_start_date! visit_detail_start_datetime
        visit_detail_end_date! visit_detail_end_datetime visit_detail_type_concept_id! provider_id care_site_id
        visit_detail_source_value visit_detail_source_concept_id admitting_source_value admitting_source_concept_id
        discharge_to_source_value discharge_to_concept_id preceding_visit_detail_id visit_detail_parent_id
        visit_occurrence_id!""",
    "procedure_occurrence": """
        procedure_occurrence_id! person_id! procedure_concept_id! procedure_date! procedure_datetime
        procedure_type_concept_id! modifier_concept_id quantity provider_id visit_occurrence_id visit_detail_id
        procedure_source_value procedure_source_concept_id modifier_source_value""",
    "device_exposure": """
        device_exposure_id! person_id! device_concept_id! device_exposure_start_date! device_exposure_start_datetime
        device_exposure_end_date device_exposure_end_datetime device_type_concept_id! unique_device_id quantity
        provider_id visit_occurrence_id visit_detail_id device_source_value device_source_concept_id""",
    "measurement": """
        measurement_id! person_id! measurement_concept_id! measurement_date! measurement_datetime measurement_time
        measurement_type_concept_id! operator_concept_id value_as_number value_as_concept_id unit_concept_id
        range_low range_high provider_id visit_occurrence_id visit_detail_id measurement_source_value
        measurement_source_concept_id unit_source_value value_source_value""",
    "observation": """
        observation_id! person_id! observation_concept_id! observation_date! observation_datetime
        observation_type_concept_id! value_as_number value_as_string value_as_concept_id qualifier_concept_id
        unit_concept_id provider_id visit_occurrence_id visit_detail_id observation_source_value
        observation_source_concept_id unit_source_value qualifier_source_value""",
    "note": """
        note_id! person_id! note_date! note_datetime note_type_concept_id! note_class_concept_id! note_title
        note_text! encoding_concept_id! language_concept_id! provider_id visit_occurrence_id visit_detail_id
        note_source_value""",
    "location": """
        location_id! address_1 address_2 city state zip county location_source_value""",
    "metadata": """
        metadata_concept_id! metadata_type_concept_id! name! value_as_string value_as_concept_id metadata_date
        metadata_datetime""",
    "cdm_source": """
        cdm_source_name! cdm_source_abbreviation! cdm_holder! source_description source_documentation_reference
        cdm_etl_reference source_release_date! cdm_release_date! cdm_version vocabulary_version!""",
    "attribute_definition": """
        attribute_definition_id! attribute_name! attribute_description attribute_type_concept_id! attribute_syntax""",
}
ONLY_54 = ["episode", "episode_event", "cohort"]

# 5.3 -> 5.4: renamed columns (old -> new) and columns that did not exist.
RENAMED = {
    "visit_occurrence": {
        "admitting_source_concept_id": "admitted_from_concept_id",
        "admitting_source_value": "admitted_from_source_value",
        "discharge_to_concept_id": "discharged_to_concept_id",
        "discharge_to_source_value": "discharged_to_source_value",
    },
    "visit_detail": {
        "admitting_source_value": "admitted_from_source_value",
        "admitting_source_concept_id": "admitted_from_concept_id",
        "discharge_to_source_value": "discharged_to_source_value",
        "discharge_to_concept_id": "discharged_to_concept_id",
        "visit_detail_parent_id": "parent_visit_detail_id",
    },
}
ADDED = {
    "procedure_occurrence": ["procedure_end_date", "procedure_end_datetime"],
    "device_exposure": ["production_id", "unit_concept_id", "unit_source_value", "unit_source_concept_id"],
    "measurement": ["unit_source_concept_id", "measurement_event_id", "meas_event_field_concept_id"],
    "observation": ["value_source_value", "observation_event_id", "obs_event_field_concept_id"],
    "note": ["note_event_id", "note_event_field_concept_id"],
    "location": ["country_concept_id", "country_source_value", "latitude", "longitude"],
    "metadata": ["metadata_id", "value_as_number"],
    "cdm_source": ["cdm_version_concept_id"],
}

SURROGATE_KEY_TABLES = [
    "observation_period", "condition_occurrence", "drug_exposure", "procedure_occurrence", "device_exposure",
    "measurement", "observation", "note", "note_nlp", "specimen", "payer_plan_period", "cost",
    "drug_era", "dose_era", "condition_era",
]
NATURAL_KEY_TABLES = [
    "person", "location", "care_site", "provider", "episode", "concept", "vocabulary", "domain",
    "concept_class", "relationship", "visit_occurrence", "visit_detail",
]
VOCABULARY_TABLES = [
    "concept", "vocabulary", "domain", "concept_class", "relationship", "concept_relationship",
    "concept_synonym", "concept_ancestor", "drug_strength",
]
HARMONIZED_TABLES = [
    "visit_occurrence", "condition_occurrence", "drug_exposure", "procedure_occurrence", "device_exposure",
    "measurement", "observation", "note", "specimen",
]
DERIVED_TABLES = {
    "condition_era": ["condition_occurrence"],
    "drug_era": ["drug_exposure"],
    "observation_period": ["person"],
}
# Site-local keys that must become globally unique; person_id is shared and stays.
SITE_KEY_COLUMNS = [
    "visit_occurrence_id", "preceding_visit_occurrence_id", "visit_detail_id", "preceding_visit_detail_id",
    "parent_visit_detail_id", "provider_id", "care_site_id", "location_id", "episode_id",
]
PRIMARY_CONCEPT = {
    "visit_occurrence": "visit_concept_id", "condition_occurrence": "condition_concept_id",
    "drug_exposure": "drug_concept_id", "procedure_occurrence": "procedure_concept_id",
    "device_exposure": "device_concept_id", "measurement": "measurement_concept_id",
    "observation": "observation_concept_id", "note": "note_class_concept_id", "specimen": "specimen_concept_id",
}
DOMAIN_TABLE = {
    "Visit": "visit_occurrence", "Condition": "condition_occurrence", "Drug": "drug_exposure",
    "Procedure": "procedure_occurrence", "Device": "device_exposure", "Measurement": "measurement",
    "Observation": "observation", "Note": "note", "Specimen": "specimen",
}
# Date column that places a row on the time axis.
EVENT_DATE = {
    "visit_occurrence": "visit_start_date", "visit_detail": "visit_detail_start_date",
    "condition_occurrence": "condition_start_date", "drug_exposure": "drug_exposure_start_date",
    "procedure_occurrence": "procedure_date", "device_exposure": "device_exposure_start_date",
    "measurement": "measurement_date", "observation": "observation_date", "note": "note_date",
    "specimen": "specimen_date",
}

# Placeholders for required values a site left out.
DEFAULTS = {
    "string": "", "date": "1970-01-01", "bigint": "-1", "double": "-1.0", "timestamp_ntz": "1970-01-01 00:00:00",
}

_TEXT_IDS = {
    "unique_device_id", "production_id", "specimen_source_id", "cost_domain_id", "domain_id", "vocabulary_id",
    "concept_class_id", "relationship_id", "reverse_relationship_id", "source_vocabulary_id", "target_vocabulary_id",
}
_COUNTS = {
    "year_of_birth", "month_of_birth", "day_of_birth", "refills", "quantity", "days_supply", "drug_exposure_count",
    "gap_days", "condition_occurrence_count", "episode_number", "box_size", "min_levels_of_separation",
    "max_levels_of_separation",
}
_AMOUNTS = {
    "value_as_number", "range_low", "range_high", "latitude", "longitude", "dose_value", "amount_value",
    "numerator_value", "denominator_value", "amount_allowed", "total_charge", "total_cost", "total_paid",
}


def column_type(name: str) -> str:
    """Type of a column, by the model's naming rules."""
    if name in _TEXT_IDS:
        return "string"
    if name.endswith(("_id", "_id_1", "_id_2")) or name in _COUNTS:
        return "bigint"
    if name in _AMOUNTS or name.startswith("paid_"):
        return "double"
    if name.endswith("_datetime"):
        return "timestamp_ntz"
    if name.endswith("_date"):
        return "date"
    return "string"


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _field(token: str, key: str | None) -> T.StructField:
    name, _, explicit = token.rstrip("!").partition(":")
    return T.StructField(
        name,
        _TYPES[explicit or column_type(name)],
        True,
        {"required": token.endswith("!"), "pk": name == key},
    )


def _struct(layout: str, table: str) -> T.StructType:
    tokens = layout.split()
    keyed = table in SURROGATE_KEY_TABLES or table in NATURAL_KEY_TABLES or table == "metadata"
    key = tokens[0].rstrip("!") if keyed else None
    return T.StructType([_field(token, key) for token in tokens])


@cache
def tables(version: str = "5.4") -> dict[str, T.StructType]:
    """Every table of a version with its layout."""
    if version == "5.4":
        return {table: _struct(layout, table) for table, layout in _LAYOUTS.items()}
    if version == "5.3":
        kept = {t: layout for t, layout in _LAYOUTS.items() if t not in ONLY_54}
        return {table: _struct(layout, table) for table, layout in {**kept, **_LAYOUTS_53}.items()}
    raise ValueError(f"unknown model version {version}")


def layout(table: str, version: str = "5.4") -> T.StructType:
    return tables(version)[table]


def primary_key(table: str, version: str = "5.4") -> str | None:
    return next((f.name for f in layout(table, version) if f.metadata["pk"]), None)


def concept_pairs(table: str, version: str = "5.4") -> list[tuple[str, str]]:
    """(X_concept_id, X_source_concept_id) columns that exist together."""
    names = layout(table, version).names
    stems = [n.removesuffix("_concept_id") for n in names
             if n.endswith("_concept_id") and not n.endswith("_source_concept_id")]
    return [(f"{s}_concept_id", f"{s}_source_concept_id") for s in stems if f"{s}_source_concept_id" in names]


def primary_pair(table: str, version: str = "5.4") -> tuple[str, str | None]:
    concept = PRIMARY_CONCEPT[table]
    return concept, dict(concept_pairs(table, version)).get(concept)


def default_text(name: str, kind: str) -> str:
    """Placeholder as text; any concept id falls back to 0, "no matching concept"."""
    return "0" if name.endswith("_concept_id") else DEFAULTS[kind]
