"""A training corpus in five stages: rules, near-duplicates, benchmark passages, personal data, mixture.

Every stage takes what the one before kept, as written Parquet. All but the
last return the columns of ``documents``; the last adds ``epoch``, as a
document stands once for each time the mixture takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm.decontaminate import decontaminate
from medloom.llm.mixing import repeat
from medloom.llm.quality import passing
from medloom.llm.sanitise import masked, sanitise
from medloom.llm.simhash import deduplicate
from medloom.sources.storage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).filter("NOT contaminated").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it masked."""
    found = sanitise(docs)
    touched = F.size("spans") > 0
    text = F.when(touched, masked(F.coalesce("text", F.lit("")), "spans")).otherwise(F.col("text"))
    found = found.withColumn("_touched", touched).withColumn("text", text)
    length = F.when(F.col("_touched"), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; ``epoch`` numbers the copies of one from 1."""
    return repeat(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("mix sources", mix_sources),
]
# Fingerprints, and so the second stage, cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
