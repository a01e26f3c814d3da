from datetime import date

from pyspark.sql import functions as F

from gridseries.functions import time as tf


def test_date_from_filename(spark):
    df = spark.createDataFrame(
        [
            ("sms-call-internet-mi-2013-11-01.txt",),
            ("notes.txt",),
            ("sms-call-internet-mi-2013-13-01.txt",),
            ("/data/raw/sms-call-internet-mi-2013-12-16.txt",),
        ],
        "name string",
    )
    out = [r[0] for r in df.select(tf.date_from_filename(F.col("name"))).collect()]
    assert out == [date(2013, 11, 1), None, None, date(2013, 12, 16)]


def test_partition_path(spark):
    df = spark.createDataFrame([(date(2013, 12, 16),)], "day date")
    r = df.select(tf.partition_path(F.col("day")).alias("p"), tf.year_month_key(F.col("day")).alias("ym")).first()
    assert r.p == "year_month=2013-12/day=2013-12-16"
    assert r.ym == "2013-12"


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 7),)], "d date")
    assert [r[0] for r in df.select(tf.weekday_mon0(F.col("d"))).collect()] == [0, 6]


def test_grid_coordinates(spark):
    df = spark.createDataFrame([(1,), (100,), (101,), (10000,)], "id int")
    got = [(r[0], r[1]) for r in df.select(tf.grid_row(F.col("id"), 100), tf.grid_col(F.col("id"), 100)).collect()]
    assert got == [(0, 0), (0, 99), (1, 0), (99, 99)]
