from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridseries.config import SeriesSpec
from gridseries.operators import evaluate as ev
from gridseries.operators import forecast as fc

SPEC = SeriesSpec(entity="square_id", ts="ts", value="value", step=600, daily=144, weekly=1008, tz="Europe/Rome")


def ramp(spark):
    # 30 rows, 10-minute step from 2013-12-15 00:00 Europe/Rome (23:00 UTC the day before)
    start = datetime(2013, 12, 14, 23, 0)
    data = [(1, start + timedelta(minutes=10 * i), float(i)) for i in range(30)]
    df = spark.createDataFrame(data, "square_id int, ts_utc timestamp_ntz, value double")
    return df.select("square_id", F.convert_timezone(F.lit("UTC"), F.lit("UTC"), "ts_utc").cast("timestamp").alias("ts"), "value")


def test_last_value_is_previous_step(spark):
    f = fc.last_value(ramp(spark), SPEC)
    w = ev.walk_forward(f, SPEC, datetime(2013, 12, 15, 1, 0), datetime(2013, 12, 15, 2, 0)).collect()
    assert len(w) == 7
    assert all(r.y_pred == r.y_true - 1 for r in w)


def test_seasonal_naive_falls_back_to_last_value(spark):
    f = fc.seasonal_naive(ramp(spark), SPEC, 144)
    w = ev.walk_forward(f, SPEC, datetime(2013, 12, 15, 1, 0), datetime(2013, 12, 15, 1, 30)).collect()
    assert len(w) == 4
    assert all(r.y_pred == r.y_true - 1 for r in w)


def test_seasonal_naive_uses_exact_key(spark):
    f = fc.seasonal_naive(ramp(spark), SPEC, 3).where(F.col("y_true") >= 3)
    assert all(r.y_pred == r.y_true - 3 for r in f.collect())


def test_empty_window_raises(spark):
    f = fc.last_value(ramp(spark), SPEC)
    with pytest.raises(ValueError):
        ev.walk_forward(f, SPEC, datetime(2014, 1, 1), datetime(2014, 1, 2), strict=True)


def test_no_leakage_from_future(spark):
    """Changing values after t never changes the forecast at t."""
    base = ramp(spark)
    cut = datetime(2013, 12, 15, 2, 0)
    changed = base.withColumn("value", F.when(F.col("ts") > F.lit(datetime(2013, 12, 15, 1, 0)), F.lit(-99.0)).otherwise(F.col("value")))
    models = {"naive_last": None, "naive_k": 3}
    a = ev.walk_forward(fc.baseline_forecasts(base, SPEC, models), SPEC, datetime(2013, 12, 15, 0, 0), datetime(2013, 12, 15, 2, 10))
    b = ev.walk_forward(fc.baseline_forecasts(changed, SPEC, models), SPEC, datetime(2013, 12, 15, 0, 0), datetime(2013, 12, 15, 2, 10))
    pa = {(r.model, r.ts): r.y_pred for r in a.collect()}
    pb = {(r.model, r.ts): r.y_pred for r in b.collect()}
    limit = datetime(2013, 12, 15, 0, 10)  # UTC: first step after the 01:00 Rome change point
    for k, v in pa.items():
        if k[1] <= limit:
            assert pb[k] == v
    assert cut
