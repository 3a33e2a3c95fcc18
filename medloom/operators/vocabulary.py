"""The denormalized concept lookup and what is derived from it."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from medloom.operators.joins import lookup_join
from medloom.sources.storage import create_once, read_completed

# Part of the fingerprint: lookups of another layout are made anew.
VERSION = "2"

MAPPING_RELATIONSHIPS = ["Maps to", "Maps to value"]
REPLACEMENT_RELATIONSHIPS = ["Concept replaced by"]


def mapping_rows(relationship: DataFrame) -> DataFrame:
    """The relationships that re-code a concept."""
    kept = F.col("relationship_id").isin(MAPPING_RELATIONSHIPS + REPLACEMENT_RELATIONSHIPS)
    return relationship.filter(kept).select(
        F.col("concept_id_1").alias("concept_id"), "relationship_id", F.col("concept_id_2").alias("target_concept_id")
    )


def concept_lookup(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Each concept with its mappings and replacements, one row per target."""
    return _resolve(concept, mapping_rows(relationship))


def _resolve(concept: DataFrame, mapped: DataFrame) -> DataFrame:
    own = concept.select(
        "concept_id", F.col("standard_concept").alias("concept_id_standard"),
        F.col("domain_id").alias("concept_id_domain"),
    )
    target = concept.select(
        F.col("concept_id").alias("target_concept_id"),
        F.col("standard_concept").alias("target_concept_id_standard"),
        F.col("domain_id").alias("target_concept_id_domain"),
    )
    # The relationships are the side on which one concept may be frequent, as
    # a source or as a target; both joins look up concepts from there. They are
    # about as many as the concepts, most of which they use: what is too large
    # to broadcast whole is not narrowed to them, but shuffles beside them.
    resolved = lookup_join(mapped, target, "target_concept_id", bound=concept, narrow=False)
    with_targets = lookup_join(resolved, own, "concept_id", "inner", bound=concept, narrow=False)
    without = own.join(mapped.select("concept_id").distinct(), "concept_id", "left_anti")
    return with_targets.unionByName(without, allowMissingColumns=True).select(
        "concept_id", "concept_id_standard", "concept_id_domain", "relationship_id", "target_concept_id",
        "target_concept_id_standard", "target_concept_id_domain",
    ).distinct()


@dataclass(frozen=True)
class Vocabulary:
    """What harmonization looks up.

    ``profiles`` has one row for each concept with all that re-coding needs to
    know of it. ``concept`` and ``mapping`` bound the rows of what is looked up
    and are cheap to count.
    """

    lookup: DataFrame
    profiles: DataFrame
    concept: DataFrame
    mapping: DataFrame

    @staticmethod
    def build(concept: DataFrame, relationship: DataFrame) -> Vocabulary:
        mapped = mapping_rows(relationship)
        lookup = _resolve(concept, mapped)
        return Vocabulary(lookup, profiles(lookup), concept, mapped)

    def store(self, path: str) -> Vocabulary:
        """Write the lookups to a new folder and read them back."""
        self.lookup.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/lookup")
        lookup = self.lookup.sparkSession.read.schema(self.lookup.schema).parquet(f"{path}/lookup")
        profiles(lookup).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/profiles")
        return Vocabulary.stored(lookup.sparkSession, path)

    @staticmethod
    def stored(spark: SparkSession, path: str) -> Vocabulary:
        lookup, profile = (spark.read.parquet(f"{path}/{n}") for n in ("lookup", "profiles"))
        return Vocabulary(lookup, profile, profile, lookup)

    @staticmethod
    def prepared(concept: DataFrame, relationship: DataFrame, root: str) -> Vocabulary:
        """The lookups of this very vocabulary below ``root``, made at its first use.

        A fingerprint of the contents names them. They are written to a folder
        of their own; the manifest that points there comes last and is written
        once, so what was cut off is never taken up, and of two that build at a
        time the first one's is used by both.
        """
        spark = concept.sparkSession
        manifest = f"{root}/manifests/{fingerprint(concept, relationship)}"
        known = _manifest(spark, manifest)
        if known is None:
            folder = f"lookups/{uuid.uuid4().hex}"
            made = Vocabulary.build(concept, relationship).store(f"{root}/{folder}")
            counts = [(folder, made.lookup.count(), made.profiles.count())]
            create_once(spark.createDataFrame(counts, _MANIFEST), manifest)
            known = _manifest(spark, manifest)
        found = Vocabulary.stored(spark, f"{root}/{known.folder}")
        if (found.lookup.count(), found.profiles.count()) != (known.lookup_rows, known.profile_rows):
            raise ValueError(f"{root}/{known.folder} does not hold what its manifest states; remove {manifest}")
        return found


_MANIFEST = "folder string, lookup_rows long, profile_rows long"


def _manifest(spark: SparkSession, path: str) -> Row | None:
    """The manifest's row, or None where none was completed."""
    found = read_completed(spark, path)
    return None if found is None else found.first()


def fingerprint(concept: DataFrame, relationship: DataFrame) -> str:
    """Digest of what the lookups are made from: columns and rows, in any order and over any files."""
    parts = []
    for df in (concept.select("concept_id", "standard_concept", "domain_id"), mapping_rows(relationship)):
        # Two independent 64-bit hashes of a row; sums as decimals, so that repeated rows count.
        one, two = (F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in df.columns]) for seed in (1, 2))
        sums = [F.sum(h.cast("decimal(38,0)")).cast("string") for h in (one, two)]
        parts.append(df.select(F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums).alias("t")).first().t)
    return hashlib.md5("|".join([VERSION, *parts]).encode()).hexdigest()


def profiles(lookup: DataFrame) -> DataFrame:
    """One row per concept: its domain, the range and the list of its targets, its value target.

    A concept has few targets, as the vocabulary's makers map by hand.
    """
    target = F.col("target_concept_id")
    entry = F.struct(target.alias("new"), F.col("target_concept_id_domain").alias("domain"), F.col("relationship_id").alias("relation"))
    is_map = _recodes() & F.col("relationship_id").isin(MAPPING_RELATIONSHIPS)
    is_replacement = _recodes() & F.col("relationship_id").isin(REPLACEMENT_RELATIONSHIPS)
    value = F.when(
        (F.col("target_concept_id_domain") == "Meas Value") | (F.col("relationship_id") == "Maps to value"), target
    )
    return lookup.groupBy("concept_id", F.col("concept_id_domain").alias("domain")).agg(
        F.min(F.when(is_map, target)).alias("map_low"), F.max(F.when(is_map, target)).alias("map_high"),
        F.min(F.when(is_replacement, target)).alias("replace_low"), F.max(F.when(is_replacement, target)).alias("replace_high"),
        F.max(value).alias("value_target"),
        F.collect_list(F.when(is_map, entry)).alias("map"), F.collect_list(F.when(is_replacement, entry)).alias("replace"),
    )


def _recodes() -> Column:
    """A standard target that is a code of its own, not the value of another."""
    return (
        (F.col("target_concept_id_standard") == "S")
        & (F.coalesce(F.col("target_concept_id_domain"), F.lit("")) != "Meas Value")
        & (F.col("relationship_id") != "Maps to value")
    )
