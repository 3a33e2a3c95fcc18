"""The views over tables of their own: what their ids give at any size of the keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebook.views import Views

MOMENT = dt.datetime(1995, 3, 1)
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string,"
         " l_linestatus string, l_shipdate timestamp_ntz")


def _views(spark, root, lines):
    rows = [(*line, "N", "O", MOMENT) for line in lines]
    spark.createDataFrame(rows, LINES).write.parquet(f"{root}/lineitem.parquet")
    orders = [(k, 7, MOMENT) for k in sorted({line[0] for line in lines if line[0] is not None})]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{root}/orders.parquet")
    return Views(spark, str(root))


def _exact(order, part, supplier, line, quantity):
    return ((order * 10 + line) * 100000 + part) * 1000000 + supplier * 100 + int(quantity)


@pytest.mark.parametrize(("view", "key"), [("f_drug", "drug_exposure_id"), ("f_measurement", "measurement_id")])
def test_line_id_of_any_order(spark, tmp_path, view, key):
    lines = [
        (0, 0, 0, 1, 1.0), (1, 19999, 999, 7, 50.0), (149999, 3, 4, 2, 5.0), (-3, 8, 9, 1, 2.0),
        # On both sides of the range of a long.
        (9223371, 1, 2, 3, 4.0), (9223372, 1, 2, 3, 4.0), (9223372, 1200000, 60000, 7, 50.0),
        (53999999, 7199999, 359999, 7, 50.0), (900000000000, 7199999, 359999, 7, 49.0),
    ]
    found = {(r.visit, r.id) for r in _views(spark, tmp_path, lines)[view].select(
        F.col("visit_occurrence_id" if view == "f_drug" else "measurement_event_id").alias("visit"), F.col(key).alias("id")).collect()}
    numbers = {(line[0], _exact(*line)) for line in lines}
    assert {n for n in numbers if -(2**63) <= n[1] < 2**63} <= found
    assert {(order, n % 2**64) for order, n in numbers} == {(order, n % 2**64) for order, n in found}


def test_line_id_without_a_part_of_it(spark, tmp_path):
    lines = [(1, None, 2, 3, 4.0), (1, 2, None, 3, 4.0), (1, 2, 3, None, 4.0), (1, 2, 3, 4, None), (1, 2, 3, 4, 5.0)]
    ids = [r.id for r in _views(spark, tmp_path, lines)["f_drug"].select(F.col("drug_exposure_id").alias("id")).collect()]
    assert ids.count(None) == 4 and _exact(1, 2, 3, 4, 5) in ids
