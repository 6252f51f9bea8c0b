import datetime as dt

from pyspark.sql import functions as F

from inkline.functions import dates as D
from conftest import one

T = dt.datetime


def test_iso_z(spark):
    p = lambda c: D.parse_ts_z(F.col(c))
    assert one(spark, p, "2023-05-04T10:11:12.345Z") == T(2023, 5, 4, 10, 11, 12, 345000)
    assert one(spark, p, "2023-05-04T10:11:12.3Z") == T(2023, 5, 4, 10, 11, 12, 300000)
    assert one(spark, p, "2023-05-04T10:11:12Z") is None          # fraction required
    assert one(spark, p, "2023-02-30T10:11:12.1Z") is None        # no such day


def test_iso_offset_keeps_wall_clock(spark):
    p = lambda c: D.parse_ts_offset(F.col(c))
    assert one(spark, p, "2023-05-04T12:30:00-03:00") == T(2023, 5, 4, 12, 30)
    assert one(spark, p, "2023-05-04T12:30:00") is None


def test_date10_fallback_parts(spark):
    assert one(spark, lambda c: D.parse_date10(F.col(c)), "2023-05-04T23:59:59+02:00") == T(2023, 5, 4)
    assert one(spark, lambda c: D.parse_date_fallback(F.col(c)), "04-05-2023") == T(2023, 5, 4)
    assert one(spark, lambda c: D.parse_date_fallback(F.col(c)), "2023-5-4") == T(2023, 5, 4)
    assert one(spark, lambda c: D.parse_date_fallback(F.col(c)), "ayer") is None
    df = spark.createDataFrame([("2023", "5", "4"), ("2023", None, "4")], "y string, m string, d string")
    got = [r[0] for r in df.select(D.parse_date_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [T(2023, 5, 4), None]


def test_format_and_age(spark):
    assert one(spark, lambda c: D.format_ts(F.col(c)), T(2023, 5, 4, 1, 2, 3), "x timestamp_ntz") == "2023-05-04 01:02:03"
    as_of = "2024-01-15 00:00:00"
    df = spark.createDataFrame([(T(2024, 1, 13, 0, 0, 1),), (T(2024, 1, 13),), (T(2024, 1, 15, 0, 0, 1),)],
                               "ts timestamp_ntz")
    rows = df.select(D.age_days(F.col("ts"), as_of).alias("a"), D.is_fresh(F.col("ts"), as_of).alias("f")).collect()
    assert [(r.a, r.f) for r in rows] == [(1, True), (2, False), (-1, True)]
