import random

from pyspark.sql import functions as F

from casebook.harmonization import QUERIES
from casebook.views import Views
from medloom.operators import dedupe


def check(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, a string, b bigint")
    got = dedupe.repair_keys(df, "k").collect()
    assert len(got) == len(rows)
    assert len({r.k for r in got}) == len({r[0] for r in rows}) + len(rows) - len({r[0] for r in rows})
    assert sorted((r.a, r.b or 0) for r in got) == sorted((a, b or 0) for _, a, b in rows)
    assert {r[0] for r in rows} <= {r.k for r in got}


def test_keys_become_unique_and_rows_stay(spark):
    rng = random.Random(3)
    check(spark, [(rng.randrange(20), rng.choice("xyz"), rng.choice([1, 2, None])) for _ in range(200)])


def test_copies_of_one_row_are_split(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "COPIES_PER_TASK", 7)
    check(spark, [(1, "same", 1)] * 100 + [(1, "other", 2), (2, "x", None)])


def test_result_does_not_depend_on_row_order(spark):
    rows = [(1, a, b) for a in "abc" for b in (1, 2)] * 2
    schema = "k bigint, a string, b bigint"
    one = dedupe.repair_keys(spark.createDataFrame(rows, schema), "k").collect()
    two = dedupe.repair_keys(spark.createDataFrame(rows[::-1], schema).repartition(5), "k").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_missing_keys_pass(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b")], "k bigint, a string")
    assert dedupe.repair_keys(df, "k").count() == 3


def test_repeated_keys(spark):
    df = spark.range(5).select(F.col("id") % 3)
    df = df.toDF("k")
    assert {(r.k, r.row_count) for r in dedupe.repeated_keys(df, "k").collect()} == {(0, 2), (1, 2)}
    distinct = df.dropDuplicates(["k"])
    assert dedupe.repair_keys(df, "k") is not df and dedupe.repair_keys(distinct, "k") is distinct


def test_copies_are_made_from_one_reading(spark, tmp_path):
    # Orders of an even, an odd and no person; a line that comes twice, one without an order and one without a number.
    orders = [(1, 10), (2, 11), (3, None)]
    lines = [(1, 1), (1, 2), (2, 1), (2, 1), (3, 1), (4, 1), (1, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int").selectExpr(
        "*", "7L AS l_partkey", "8L AS l_suppkey", "9D AS l_quantity", "timestamp'1998-01-02' AS l_shipdate", "'N' AS l_returnflag",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    counted = QUERIES["repeated_keys"](Views(spark, str(tmp_path)))
    assert sorted((r.dup_key or 0, r.row_count) for r in counted.collect()) == [(0, 2), (11, 2), (12, 2), (21, 2)]
    # Lines and orders are each read once, not once for the rows and again for their copies.
    assert counted._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
