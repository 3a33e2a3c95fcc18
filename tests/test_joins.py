"""Joins, numbering and lists under a hot key."""

import pytest
from pyspark.sql import functions as F

from medloom.operators import joins
from medloom.operators.ranking import number_rows


def hot_rows(spark):
    """A third of the rows, copies included, share one key."""
    return spark.range(0, 3000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 5).alias("x"))


@pytest.mark.parametrize("pieces", [joins.SIEVE_PIECES, 1])
def test_sieve_lets_every_key_pass(spark, monkeypatch, pieces):
    monkeypatch.setattr(joins, "SIEVE_PIECES", pieces)
    keys = joins.materialize(spark.range(5000).select(F.xxhash64("id").alias("h")), "keys")
    bits = joins.sieve(keys)
    assert bits.count() == 1
    passed = spark.range(10_000).filter(joins.passes(bits, F.xxhash64("id")))
    assert passed.filter("id < 5000").count() == 5000
    # One bit in sixteen is set, or one in seven of a single piece.
    assert passed.count() < 5000 + (500 if pieces > 1 else 1000)
    none = joins.sieve(joins.materialize(keys.limit(0), "keys"))
    assert spark.range(100).filter(joins.passes(none, F.xxhash64("id"))).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_is_exact(spark, how):
    left = hot_rows(spark)
    right = spark.range(0, 30).select(F.col("id").alias("k"), F.explode(F.array(F.lit(1), F.lit(2))).alias("y"))
    expected = left.join(right, "k", how)
    got = joins.salted_join(left, right, ["k"], how)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_salted_join_spreads_the_hot_key(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.range(0, 50).select(F.col("id").alias("k"))
        joined = joins.salted_join(hot_rows(spark), right, ["k"], "inner").withColumn("p", F.spark_partition_id())
        spread = joined.filter("k = 7").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(spread) > 1


def test_only_heavy_keys_are_salted(spark, no_broadcast):
    """One key of half the rows: its right rows are repeated, all others stand once."""
    left = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(1).alias("x"))
    heavy = joins.heavy_keys(left, ["k"])
    assert len(heavy) == 1 and abs(next(iter(heavy.values())) - 0.5) < 0.01
    right = spark.range(-1, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    seen = []
    join = type(left).join
    left.__class__.join = lambda self, other, *a, **k: seen.append(other) or join(self, other, *a, **k)
    try:
        joined = joins.salted_join(left, right, ["k"], "left")
    finally:
        left.__class__.join = join
    copies = {r.k: r["count"] for r in seen[0].groupBy("k").count().collect()}
    assert copies.pop(-1) > 1 and set(copies.values()) == {1}
    assert joined.exceptAll(left.join(right, "k", "left")).isEmpty() and joined.count() == 4000
    # Without a heavy key nothing is salted.
    even = spark.range(0, 3000).select((F.col("id") % 1000).alias("k"))
    assert joins.heavy_keys(even, ["k"]) == {} and "_salt" not in plan(joins.salted_join(even, right, ["k"], "left"))
    assert joins.heavy_keys(even.limit(0), ["k"]) == {}


@pytest.mark.parametrize("limit", ["0", "500", None])
def test_results_at_every_limit(spark, limit):
    left, right = hot_rows(spark), spark.range(0, 900).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    expected = left.join(right, "k", "left")
    if limit is not None:
        spark.conf.set("spark.medloom.broadcastRows", limit)
    try:
        got = joins.lookup_join(left, right, "k")
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    finally:
        spark.conf.unset("spark.medloom.broadcastRows")


def test_lookup_join_checks_the_size(spark):
    left = hot_rows(spark)
    right = spark.range(0, 30).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    expected = sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    assert "BroadcastHashJoin" in plan(joins.lookup_join(left, right, "k"))
    for limit in ("0", "10", "29"):
        spark.conf.set("spark.medloom.broadcastRows", limit)
        try:
            df = joins.lookup_join(left, spark.range(0, 30).select(F.col("id").alias("k"), F.lit("v").alias("v")), "k")
            assert sorted(map(tuple, df.collect()), key=str) == expected
        finally:
            spark.conf.unset("spark.medloom.broadcastRows")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_narrows_to_used_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k bigint")
    right = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.medloom.broadcastRows", "10")
    try:
        df = joins.lookup_join(left, right, "k", "inner")
        assert "_salt" not in plan(df)
        assert sorted(map(tuple, df.collect())) == [(1, 2), (2, 4), (2, 4)]
    finally:
        spark.conf.unset("spark.medloom.broadcastRows")


def test_numbering_matches_a_window(spark):
    rows = spark.range(0, 500).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("o"))
    got = number_rows(rows, ["g"], F.substring("o", 1, 1), ["o"])
    from pyspark.sql import Window

    expected = rows.withColumn("_n", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("bigint"))
    assert got.select("g", "o", "_n").exceptAll(expected).isEmpty() and got.count() == 500


def test_numbering_by_weight(spark):
    rows = spark.createDataFrame([("a", "x", 3), ("a", "y", 2), ("a", "z", 1), ("b", "x", 1)], "g string, o string, w bigint")
    got = number_rows(rows, ["g"], F.col("o"), ["o"], weight="w", out="first")
    assert sorted((r.g, r.o, r["first"]) for r in got.collect()) == [("a", "x", 1), ("a", "y", 4), ("a", "z", 6), ("b", "x", 1)]


def test_join_finds_heavy_keys_in_a_counted_lookup(spark, no_broadcast, monkeypatch):
    from medloom.operators import joins

    def looked(*_):
        raise AssertionError("the rows are read once more for their heavy keys")

    monkeypatch.setattr(joins, "heavy_keys", looked)
    # One key with most of the rows, a missing one, and one that the lookup does not know.
    rows = spark.createDataFrame([(1, i) for i in range(500)] + [(k, k) for k in range(2, 60)] + [(None, 0), (99, 0)], "k long, i long")
    lookup = rows.filter("k < 60").groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "n", "k * 10 AS v")
    assert set(joins.counted_keys(lookup, ["k"], "n").values()) == {500 / 558}
    found = joins.lookup_join(rows, lookup, "k", narrow=False, number="n")
    assert found.columns == ["k", "i", "v"]
    expected = sorted((str(k), i, str(None if k in (None, 99) else k * 10)) for k, i in rows.collect())
    assert sorted((str(r.k), r.i, str(r.v)) for r in found.collect()) == expected


def test_pairs_are_counted_once_for_a_large_vocabulary(spark, no_broadcast, monkeypatch):
    from medloom.operators import harmonize as h, joins
    from medloom.operators.vocabulary import Vocabulary

    read = []
    monkeypatch.setattr(joins, "heavy_keys", lambda df, on: read.append(on) or {})
    concept = spark.createDataFrame([(1, "S", "Drug"), (2, None, "Drug")], "concept_id long, standard_concept string, domain_id string")
    relation = spark.createDataFrame([(2, 1, "Maps to")], "concept_id_1 long, concept_id_2 long, relationship_id string")
    rows = spark.createDataFrame([(1, 2, 2), (1, 1, 1), (2, 2, 2), (3, None, 0)], "key long, drug_concept_id long, drug_source_concept_id long")
    found = h.harmonize(rows, "drug_exposure", Vocabulary.build(concept, relation), repeated_key="key")
    assert sorted(r.key for r in found.collect()) == [1, 2, 3]
    # Neither the rows by pair nor those by key are read for a sketch.
    assert not [on for on in read if on in (["_pair_s", "_pair_t"], ["key"])]


def _coded(spark):
    from medloom.operators.vocabulary import Vocabulary

    concept = spark.createDataFrame(
        [(i, None if i % 2 == 0 else "S", ["Drug", "Measurement", "Observation"][i % 3]) for i in range(1, 40)],
        "concept_id long, standard_concept string, domain_id string")
    relation = spark.createDataFrame(
        [(i, i + 1, "Maps to") for i in range(2, 38, 4)] + [(i, i + 3, "Maps to") for i in range(2, 34, 8)]
        + [(i, i + 1, "Concept replaced by") for i in range(4, 38, 4)] + [(i, i + 2, "Maps to value") for i in range(2, 30, 4)],
        "concept_id_1 long, concept_id_2 long, relationship_id string")
    ids = [None, 0, *range(1, 42)]
    rows = spark.createDataFrame(
        [(i, ids[i % 43], ids[(i * 7) % 41], f"r{i}") for i in range(300)] + [(i, 5, 6, "hot") for i in range(300, 500)],
        "key long, drug_concept_id long, drug_source_concept_id long, note string")
    return rows, Vocabulary.build(concept, relation)


@pytest.mark.parametrize("large", [False, True])
def test_one_step_or_table_is_a_filter_of_all(spark, large):
    from medloom.operators import harmonize as h

    rows, codes = _coded(spark)

    def told(df):
        return sorted(map(str, df.collect()))

    whole = h.harmonize(rows, "drug_exposure", codes, h.STEPS)
    expected = told(whole)
    if large:
        spark.conf.set("spark.medloom.broadcastRows", "10")
    try:
        assert told(h.harmonize(rows, "drug_exposure", codes, h.STEPS)) == expected
        for step in h.STEPS:
            one = whole.filter(F.col("vocab_harmonization_status") == h.STATUS[step])
            assert one.count() and told(h.harmonize(rows, "drug_exposure", codes, h.STEPS, only_step=step)) == told(one)
        for table in ("drug_exposure", "measurement", "observation"):
            one = whole.filter(F.col("target_table") == table)
            assert one.count() and told(h.harmonize(rows, "drug_exposure", codes, h.STEPS, only_table=table)) == told(one)
    finally:
        spark.conf.unset("spark.medloom.broadcastRows")


def test_rows_meet_only_the_pairs_that_come_to_something(spark):
    from medloom.operators import harmonize as h

    rows, codes = _coded(spark)
    spark.conf.set("spark.medloom.broadcastRows", "30")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every = plan(h.harmonize(rows, "drug_exposure", codes))
        one = plan(h.harmonize(rows, "drug_exposure", codes, only_step=h.SOURCE_BACKFILL))
    finally:
        spark.conf.unset("spark.medloom.broadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in every
    assert "BroadcastHashJoin" in one and "SortMergeJoin" not in one


@pytest.mark.parametrize("asked", [{"only_step": "source_target"}, {"only_step": "target_remap"},
                                   {"only_step": "target_replacement"}, {"only_table": "observation"}])
def test_rows_are_sieved_before_they_are_joined(spark, asked):
    """Rows that were made by a join are left out before it, where their ids tell."""
    from medloom.operators import harmonize as h

    rows, codes = _coded(spark)
    orders = spark.range(600).select((F.col("id") % 500).alias("order_key"), F.col("id").alias("person"))
    made = rows.join(orders, F.col("key") == F.col("order_key")).drop("order_key")
    expected = h.harmonize(made, "drug_exposure", codes, h.STEPS, **asked)
    expected = sorted(map(str, expected.collect()))
    spark.conf.set("spark.medloom.broadcastRows", "30")
    try:
        found = h.harmonize(made, "drug_exposure", codes, h.STEPS, **asked)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert expected and sorted(map(str, found.collect())) == expected
    finally:
        spark.conf.unset("spark.medloom.broadcastRows")
    assert "scalar-subquery" in plan[plan.index("order_key"):]


def test_a_concept_of_two_domains_multiplies_rows(spark):
    """Whatever the size of the vocabulary, and although one step is asked for."""
    from medloom.operators import harmonize as h
    from medloom.operators.vocabulary import Vocabulary

    concept = spark.createDataFrame(
        [(1, "S", "Drug"), (2, None, "Drug"), (3, "S", "Drug"), (3, "S", "Device")], "concept_id long, standard_concept string, domain_id string")
    relation = spark.createDataFrame([(2, 1, "Maps to")], "concept_id_1 long, concept_id_2 long, relationship_id string")
    rows = spark.createDataFrame([(1, 3, 2), (2, 1, 2), (3, 0, 2)], "key long, drug_concept_id long, drug_source_concept_id long")
    codes, found = Vocabulary.build(concept, relation), []
    for limit in ("1000", "2"):
        spark.conf.set("spark.medloom.broadcastRows", limit)
        try:
            found.append(sorted(r.key for r in h.harmonize(rows, "drug_exposure", codes, only_step=h.SOURCE_TARGET).collect()))
        finally:
            spark.conf.unset("spark.medloom.broadcastRows")
    assert found == [[1, 1, 3], [1, 1, 3]]
