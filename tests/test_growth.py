"""What grows with the tables: frames sent through the driver, bytes of scratch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from casebook import routing
from casebook.views import Views
from medloom.operators.harmonize import _with_profiles
from medloom.operators.vocabulary import Vocabulary
from medloom.sources.publish import write_parquet


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


@pytest.fixture
def few_broadcast(spark):
    """A vocabulary of more concepts than may be broadcast, of which fewer are in use."""
    spark.conf.set("spark.medloom.broadcastRows", "10")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    concept = spark.range(100).select(
        F.col("id").alias("concept_id"), F.lit("Drug").alias("domain_id"), F.lit("S").alias("standard_concept"))
    relationship = spark.range(50).select(
        F.col("id").alias("concept_id_1"), (F.col("id") % 5 + 90).alias("concept_id_2"), F.lit("Maps to").alias("relationship_id"))
    yield concept, relationship
    spark.conf.unset("spark.medloom.broadcastRows")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_vocabulary_does_not_pass_the_driver(spark, few_broadcast):
    vocabulary = Vocabulary.build(*few_broadcast)
    assert "Broadcast" not in _plan(vocabulary.lookup)
    rows = {(r.concept_id, r.target_concept_id) for r in vocabulary.lookup.collect()}
    assert rows == {(i, i % 5 + 90 if i < 50 else None) for i in range(100)}


def test_profiles_of_a_large_vocabulary_do_not_pass_the_driver(spark, few_broadcast):
    pairs = spark.createDataFrame([(1, 2), (2, 0), (None, 3), (500, 99)], "_source long, _target long")
    found = _with_profiles(pairs, Vocabulary.build(*few_broadcast))
    assert "Broadcast" not in _plan(found)
    known = {(r._source, r._target): (r._s_map_low, r._t_map_low, r._s_known, r._t_known) for r in found.collect()}
    assert known == {(1, 2): (91, 92, True, True), (2, 0): (92, 90, True, True),
                     (None, 3): (None, 93, None, True), (500, 99): (None, None, None, True)}


def test_compact_scratch_is_small_and_holds_the_same(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 2).select(
        *[(F.col("id") * 1000 + i).alias(f"number_{i}") for i in range(5)],
        F.concat(F.lit("some text:"), "id").alias("text"), F.when(F.col("id") % 5 != 0, F.col("id") / 2).alias("half"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("id") % 700).cast("int")).alias("day"),
        F.lit(dt.datetime(1995, 1, 1, 1)).cast("timestamp_ntz").alias("moment"), (F.col("id") % 3).alias("kind"))
    plain = write_parquet(rows, str(tmp_path / "plain"), partition_by=["kind"])
    compact = write_parquet(rows, str(tmp_path / "compact"), partition_by=["kind"], compact=True)
    assert compact.schema == plain.schema
    assert compact.count() == 40_000 and compact.exceptAll(plain).isEmpty() and rows.exceptAll(compact).isEmpty()
    assert _bytes(tmp_path / "compact") * 2 < _bytes(tmp_path / "plain")


def test_orders_are_dealt_in_ranges_of_keys(spark, tmp_path):
    day = F.lit(dt.datetime(1995, 1, 1)).cast("timestamp_ntz")
    some = spark.range(3_000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), day.alias("o_orderdate"))
    hot = spark.range(3_000).select(F.lit(17).cast("long").alias("o_orderkey"), F.col("id").alias("o_custkey"), day.alias("o_orderdate"))
    missing = spark.range(2).select(F.lit(None).cast("long").alias("o_orderkey"), F.col("id").alias("o_custkey"), day.alias("o_orderdate"))
    some.union(hot).union(missing).write.parquet(f"{tmp_path}/orders.parquet")
    dealt = routing._dealt(Views(spark, str(tmp_path)))
    parts = dealt.rdd.map(lambda r: r.o_orderkey).glom().collect()
    assert sum(map(len, parts)) == 6_002 and sum(k is None for p in parts for k in p) == 2
    given = [[k for k in p if k is not None] for p in parts]
    assert all(p == sorted(p) for p in given)
    ends = [(p[0], p[-1]) for p in given if p]
    assert all(high <= low for (_, high), (low, _) in zip(ends, ends[1:]))
    # Rows of one key go over several tasks.
    assert sum(17 in p for p in given) > 2 and max(map(len, parts)) < 3_000
