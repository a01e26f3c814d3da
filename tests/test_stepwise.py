"""Step models against the window forecasts, and what they may see."""

import random
from datetime import datetime, timedelta

from gridseries.config import SeriesSpec, Split
from gridseries.operators import forecast as fc
from gridseries.operators import stepwise as sw

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
T0 = datetime(2024, 1, 1)


def gappy(spark):
    rnd = random.Random(2)
    rows = [(e, T0 + timedelta(minutes=60 * i + (30 if rnd.random() < 0.05 else 0)), None if rnd.random() < 0.05 else float(rnd.randrange(50))) for e in (1, 2, None) for i in range(200) if rnd.random() < 0.8]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double")


def test_last_value_equals_the_window_forecast_row_for_row(spark):
    s = gappy(spark)
    key = lambda r: (r.id or 0, r.ts)
    want = sorted(fc.last_value(s, SPEC).collect(), key=key)
    got = sorted(sw.step_forecasts(s, SPEC, sw.LastValue, "naive_last").collect(), key=key)
    assert got == want and len(got) > 400


def test_a_model_is_fitted_once_on_bounded_training_rows_and_sees_the_past_only(spark):
    class Probe:
        memory = 5

        def __init__(self):
            self.seen = []

        def fit(self, history):
            self.seen.append([v for _, v in history])

        def predict_one_step(self, history, target):
            assert len(history) <= 5 and all(t <= target - 3600 for t, _ in history)
            return float(len(self.seen) * 1000 + sum(self.seen[0]))

    rows = [(1, T0 + timedelta(hours=i), float(i)) for i in range(40)]
    s = spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double")
    split = Split(T0, T0 + timedelta(hours=19), T0 + timedelta(hours=20), T0 + timedelta(hours=29), T0 + timedelta(hours=30), T0 + timedelta(hours=39))
    got = sorted(sw.step_forecasts(s, SPEC, Probe, "probe", split).collect(), key=lambda r: r.ts)
    assert [r.y_pred for r in got] == [None] * 20 + [1000.0 + 15 + 16 + 17 + 18 + 19] * 20


def test_empty_series(spark):
    assert sw.step_forecasts(gappy(spark).limit(0), SPEC, sw.LastValue, "x").count() == 0
