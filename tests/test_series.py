from datetime import datetime

from pyspark.sql import functions as F

from gridseries.config import SeriesSpec
from gridseries.operators import series as ser
from gridseries.operators import windows as win

from .conftest import rows

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")


def _series(spark, values, entity=1):
    data = [(entity, datetime(2024, 1, 1, i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "id int, ts timestamp_ntz, v double")


def test_interpolate_positional_with_edges(spark):
    # NULL, 1, NULL, NULL, 4, NULL -> 1, 1, 2, 3, 4, 4
    out = ser.interpolate(_series(spark, [None, 1.0, None, None, 4.0, None]), SPEC).orderBy("ts")
    assert [r.v for r in out.collect()] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_missing_bins_and_regularise(spark):
    df = _series(spark, [1.0, 2.0, 3.0, 4.0]).where(F.hour("ts") != 2)
    assert [r.ts.hour for r in ser.missing_bins(df, SPEC).collect()] == [2]
    reg = ser.regularise(df, SPEC).orderBy("ts")
    assert [r.v for r in reg.collect()] == [1.0, 2.0, None, 4.0]


def test_area_totals_top_k_ties(spark):
    df = _series(spark, [1.0, 2.0], 3).unionByName(_series(spark, [3.0], 1)).unionByName(_series(spark, [0.5], 2))
    tot = ser.area_totals(df, SPEC)
    top = ser.top_k(tot, SPEC, 2).collect()
    assert [(r.id, r.total) for r in top] == [(1, 3.0), (3, 3.0)]


def test_resolve_areas(spark):
    tot = spark.createDataFrame([(7, 1.0), (9, 5.0)], "id int, total double")
    got = rows(ser.resolve_areas(spark, "top, 7 ,, TOP", tot, SPEC), "position", "label", "id")
    assert got == [(0, "top(9)", 9), (1, "7", 7)]


def test_areas_wide_averages_duplicates(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), 2.0), (1, datetime(2024, 1, 1), 4.0), (2, datetime(2024, 1, 1), 1.0)],
        "id int, ts timestamp_ntz, v double",
    )
    r = ser.areas_wide(df, SPEC, [1, 2]).first()
    assert (r.area_1, r.area_2) == (3.0, 1.0)


def test_rolling_stats_full_windows_only(spark):
    out = win.rolling_stats(_series(spark, [1.0, 2.0, 3.0, 4.0]), SPEC, 3).orderBy("ts").collect()
    assert [r.rolling_mean for r in out] == [None, None, 2.0, 3.0]
    assert out[2].rolling_std == 1.0


def test_split_labels(spark):
    from gridseries.config import EVENTS_SPLIT

    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 20, 23), 1.0), (1, datetime(2024, 1, 21, 0), 1.0), (1, datetime(2024, 1, 30, 23), 1.0), (1, datetime(2024, 2, 1), 1.0)],
        "id int, ts timestamp_ntz, v double",
    )
    got = [r.split for r in ser.with_split(df, SPEC, EVENTS_SPLIT).orderBy("ts").collect()]
    assert got == ["train", "validation", "test", None]
