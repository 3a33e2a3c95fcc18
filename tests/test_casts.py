import datetime as dt

import pytest
from pyspark.sql import functions as F

from medloom.functions import casts
from medloom.functions.keys import content_key, name_key, site_key


def read(spark, reader, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", reader(F.col("t")).alias("x")).orderBy("i").collect()]


def test_whole_numbers(spark):
    given = {"12": 12, "-7": -7, "12.7": 13, "-12.5": -13, "1e3": 1000, "5.": 5, ".5": 1, " 12 ": 12, "5d": None,
             "5f": None, "abc": None, "": None, "inf": None, "1e30": None, "9223372036854775807": 9223372036854775807,
             "9223372036854775808": None, None: None}
    assert read(spark, casts.as_long, list(given)) == list(given.values())


def test_numbers(spark):
    given = {"12.5": 12.5, "1e3": 1000.0, "5d": None, "5.0F": None, "x": None, None: None}
    assert read(spark, casts.as_double, list(given)) == list(given.values())


def test_dates(spark):
    given = {"2024-01-05": dt.date(2024, 1, 5), "2024-1-5": dt.date(2024, 1, 5), "2024/01/05": dt.date(2024, 1, 5),
             " 2024-01-05 ": dt.date(2024, 1, 5), "2024-01-05 10:00:00": dt.date(2024, 1, 5),
             "2024-01-05T10:00:00Z": dt.date(2024, 1, 5), "2024": None, "2024-01": None, "20240105": None,
             "2024-13-01": None, "2024-02-30": None, "2024-01-05 25:00:00": None, "1/5/2024": None, "": None, None: None}
    assert read(spark, casts.as_date, list(given)) == list(given.values())


def test_timestamps_ignore_the_session_zone(spark):
    # 02:30 does not exist on this day in New York, the zone of the session.
    given = {"2024-03-10 02:30:00": dt.datetime(2024, 3, 10, 2, 30), "2024-01-05": dt.datetime(2024, 1, 5),
             " 2024-01-05": None, "2024-01-05 10": None, "nope": None}
    assert read(spark, casts.as_timestamp, list(given)) == list(given.values())
    parsed = read(spark, lambda c: casts.parse_timestamp(c, "%m/%d/%Y %H:%M"), ["3/10/2024 02:30", "03/10/2024", "x"])
    assert parsed == [dt.datetime(2024, 3, 10, 2, 30), None, None]


@pytest.mark.parametrize("fmt, text", [
    ("%Y%m%d", "20240105"), ("%d-%b-%Y", "5-Jan-2024"), ("%m/%d/%Y", "1/5/2024"), ("%Y-%m-%dT%H:%M:%S", "2024-01-05T00:00:00"),
    ("%d.%m.%y", "05.01.24"), ("%m/%d/%Y %I:%M:%S %p", "01/05/2024 12:00:00 AM"),
])
def test_site_formats(spark, fmt, text):
    assert read(spark, lambda c: casts.parse_timestamp(c, fmt), [text]) == [dt.datetime(2024, 1, 5)]


def test_unknown_directive_is_refused():
    with pytest.raises(ValueError):
        casts.spark_pattern("%Q")


def test_temporal_falls_back_in_order(spark):
    read_date = lambda c: casts.cast_temporal(c, "date", "%m/%d/%Y", F.lit("1970-01-01").cast("date"))
    assert read(spark, read_date, ["01/05/2024", "2024-01-05", "never", None]) == [
        dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(1970, 1, 1), dt.date(1970, 1, 1)]


def test_keys(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "3")], "a string, b string")
    rows = df.select(content_key(["a", "b"]).alias("k"), site_key("a", "s1").alias("s"), site_key("a", "s2").alias("t")).collect()
    assert rows[0].k != rows[1].k  # the parts are separated
    assert all(0 <= r.k < 2**60 for r in rows)
    assert rows[2].s is None and rows[0].s != rows[0].t
    abc = spark.range(1).select(content_key([F.lit("abc")]).alias("k")).first().k
    assert abc == 648541476951500027


def test_name_key_is_positive_and_stable(spark):
    import hashlib

    names = ["Site A", "Site B", "x", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for row in df.select("n", name_key(F.col("n")).alias("k")).collect():
        head = int.from_bytes(hashlib.sha256(row.n.encode()).digest()[:8], "big")
        assert row.k == head % 2**63
