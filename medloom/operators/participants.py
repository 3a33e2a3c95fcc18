"""Checking delivered people against the study's participant registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.casts import as_long, whole_number
from medloom.operators.joins import lookup_join

VERIFIED = 197316935
YES = 353358909

# Registry status codes and their labels: fixed values of the registry.
STATUS_LABELS = {
    "197316935": "Verified",
    "875007964": "Not Yet Verified",
    "290379732": "No Longer Enrolling",
    "160161595": "Outreach timed Out",
    "922622075": "Duplicate",
    "219863910": "Cannot be Verified",
    "104430631": "No",
    "353358909": "Yes",
}
COMPLETION_LABELS = {
    "972455046": "Not Started",
    "615768760": "Started",
    "231311385": "Submitted",
}
# Registry variables: coded participant statuses, survey statuses, moments.
STATUS_VARIABLES = {
    "verified_status": "d_821247024",
    "consent_withdrawn": "d_747006172",
    "hipaa_revoked": "d_773707518",
    "data_destruction_requested": "d_831041022",
}
COMPLETION_VARIABLES = {
    "module1_status": "d_949302066",
    "module2_status": "d_536735468",
    "module3_status": "d_976570371",
    "module4_status": "d_663265240",
    "menstrual_status": "d_459098666",
    "covid19_status": "d_220186468",
    "experience2024_status": "d_956490759",
}
MOMENT_VARIABLES = {
    "consent_withdrawn_ts": "d_659990606",
    "hipaa_revoked_ts": "d_664453818",
    "data_destruction_ts": "d_269050420",
    "module1_complete_ts": "d_517311251",
    "module2_complete_ts": "d_832139544",
    "module3_complete_ts": "d_770257102",
    "module4_complete_ts": "d_264644252",
    "menstrual_complete_ts": "d_217640691",
    "covid19_complete_ts": "d_784810139",
    "experience2024_complete_ts": "d_199471989",
}
UNKNOWN = "UNKNOWN"


def decode_status(participants: DataFrame, site: Column | None = None, id_column: str = "connect_id") -> DataFrame:
    """Registry rows with their status codes spelled out."""
    rows = participants.filter(F.col(id_column).isNotNull())
    if site is not None:
        rows = rows.filter(site)

    def labels(table: dict[str, str], variable: str) -> Column:
        decoded = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        return F.coalesce(decoded[F.coalesce(F.col(variable), F.lit(""))], F.lit(UNKNOWN))

    columns = [F.col(id_column)]
    for table, variables in ((STATUS_LABELS, STATUS_VARIABLES), (COMPLETION_LABELS, COMPLETION_VARIABLES)):
        for name, variable in variables.items():
            columns += [labels(table, variable).alias(name), F.col(variable).alias(f"{name}_concept_id")]
    columns += [F.col(variable).alias(name) for name, variable in MOMENT_VARIABLES.items()]
    return rows.select(*columns).distinct()


def _code(name: str) -> Column:
    return as_long(F.col(f"{name}_concept_id").cast("string"))


def _registry_id() -> Column:
    return as_long(F.col("connect_id").cast("string"))


def registry_people(registry: DataFrame) -> DataFrame:
    """One row per registered id, and whether a rule excludes it.

    An absent status does not exclude.
    """
    excluded = (
        F.coalesce(_code("verified_status") != VERIFIED, F.lit(False))
        | F.coalesce(_code("consent_withdrawn") == YES, F.lit(False))
        | F.coalesce(_code("hipaa_revoked") == YES, F.lit(False))
        | F.coalesce(_code("data_destruction_requested") == YES, F.lit(False))
    )
    return (
        registry.select(_registry_id().alias("_person"), excluded.alias("_excluded"))
        .filter(F.col("_person").isNotNull())
        .groupBy("_person").agg(F.max("_excluded").alias("_excluded"))
    )


def eligible_rows(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of known, not excluded people; tables without people pass whole."""
    if "person_id" not in df.columns:
        return df
    kept = registry_people(registry).filter(~F.col("_excluded")).select("_person")
    people = df.withColumn("_person", whole_number(df, "person_id")).filter(F.col("_person") != -1)
    return lookup_join(people, kept, "_person", "left_semi", bound=registry).drop("_person")


def removal_counts(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows the filter removes, by the first reason that applies.

    Rows are counted per person first, so only one row a person is joined.
    """
    per_person = df.groupBy(whole_number(df, "person_id").alias("_person")).agg(F.count(F.lit(1)).alias("n"))
    joined = per_person.join(registry_people(registry), "_person", "left")
    unknown = F.col("_person").isNull() | (F.col("_person") == -1)
    reason = (
        F.when(unknown, "unknown_identifier")
        .when(F.col("_excluded").isNull(), "identifier_not_in_registry")
        .when(F.col("_excluded"), "exclusion_rules")
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(reason == name, F.col("n"))), F.lit(0)).alias(f"{name}_count")

    return joined.agg(total("unknown_identifier"), total("identifier_not_in_registry"), total("exclusion_rules"))


def unmatched_ids(df: DataFrame, registry: DataFrame, invalid: DataFrame | None = None) -> DataFrame:
    """Delivered ids the registry does not hold, unreadable ones included."""
    delivered = df.select(whole_number(df, "person_id").alias("_person")).filter("_person != -1").distinct()
    known = registry.select(_registry_id().alias("_person")).distinct()
    out = delivered.join(known, "_person", "left_anti").select(F.col("_person").cast("string").alias("unmatched_id"))
    if invalid is not None:
        # The same rule by which normalization picks the id column.
        names = [c for c in invalid.columns if "connectid" in c.lower() or "connect_id" in c.lower()]
        text = F.col(names[0] if names else "person_id").cast("string")
        unreadable = invalid.filter((F.trim(text) != "") & as_long(text).isNull()).select(text.alias("unmatched_id"))
        out = out.unionByName(unreadable).distinct()
    return out


def patient_count(ids: DataFrame) -> DataFrame:
    """How many ids there are; one row, also where there are none."""
    return ids.agg(F.count(F.lit(1)).alias("patient_count"))


def undelivered_ids(registry: DataFrame, person: DataFrame) -> DataFrame:
    """Eligible registered ids without a delivered person.

    Unlike the filter, an absent verification status makes an id ineligible.
    """
    eligible = (
        (F.coalesce(_code("verified_status"), F.lit(0)) == VERIFIED)
        & (F.coalesce(_code("consent_withdrawn"), F.lit(0)) != YES)
        & (F.coalesce(_code("hipaa_revoked"), F.lit(0)) != YES)
        & (F.coalesce(_code("data_destruction_requested"), F.lit(0)) != YES)
    )
    ids = registry.filter(eligible).select(_registry_id().alias("connect_id")).filter("connect_id IS NOT NULL")
    delivered = person.select(whole_number(person, "person_id").alias("connect_id")).distinct()
    return ids.distinct().join(delivered, "connect_id", "left_anti")


def matched_people(registry: DataFrame, person: DataFrame) -> DataFrame:
    """Registry statuses of the delivered people."""

    def label(name: str) -> Column:
        text = F.trim(F.col(name).cast("string"))
        return F.when(F.coalesce(text, F.lit("")) == "", UNKNOWN).otherwise(text).alias(name)

    statuses = registry.select(
        _registry_id().alias("person_id"),
        *[c for name in STATUS_VARIABLES for c in (label(name), _code(name).alias(f"{name}_concept_id"))],
    ).filter("person_id IS NOT NULL").distinct()
    delivered = person.select(whole_number(person, "person_id").alias("person_id")).distinct()
    return statuses.join(delivered, "person_id", "left_semi")


_STATUS = ["status_kind", "status_value", "status_concept_id"]


def _statuses(registry: DataFrame, person: DataFrame) -> DataFrame:
    """One row per delivered person and kind of status."""
    kinds = F.array(*[
        F.struct(
            F.lit(name).alias("status_kind"), F.col(name).alias("status_value"),
            F.col(f"{name}_concept_id").alias("status_concept_id"),
        ) for name in STATUS_VARIABLES
    ])
    rows = matched_people(registry, person).select("person_id", F.explode(kinds).alias("k"))
    return rows.select("person_id", "k.*")


def status_breakdown(registry: DataFrame, person: DataFrame) -> DataFrame:
    """Delivered people per status of each kind.

    All four kinds come from one pass over the matched people.
    """
    return _statuses(registry, person).groupBy(*_STATUS).agg(F.countDistinct("person_id").alias("patient_count"))


def status_ids(registry: DataFrame, person: DataFrame) -> DataFrame:
    """The people whose status excludes them, a row for each person and status."""
    excludes = (
        ((F.col("status_kind") == "verified_status") & (F.col("status_concept_id") != VERIFIED))
        | ((F.col("status_kind") != "verified_status") & (F.col("status_concept_id") == YES))
    )
    return _statuses(registry, person).filter(excludes).select(*_STATUS, "person_id").distinct()
