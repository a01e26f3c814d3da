from datetime import datetime, timedelta

import numpy as np

from gridseries.config import DhrConfig, SeriesSpec, Split
from gridseries.operators import tuning as tun

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
T0 = datetime(2024, 1, 1)
SPLIT = Split(T0, datetime(2024, 1, 14, 23), datetime(2024, 1, 15), datetime(2024, 1, 17, 23), datetime(2024, 1, 18), datetime(2024, 1, 20, 23))


def _series(spark, n=2, days=20):
    rng = np.random.default_rng(3)
    rows = [
        (e, T0 + timedelta(hours=i), float(30 + 5 * e + 8 * np.sin(2 * np.pi * i / 24) + rng.normal()))
        for e in range(n)
        for i in range(24 * days)
    ]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double")


def test_naive_trials_flatten_and_best(spark):
    res = tun.naive_trials(_series(spark), SPEC, SPLIT, {"last": None, "day": 24})
    flat = tun.as_rows(res, ["period"]).collect()
    assert {r["param.period"] for r in flat} == {"last", "24"}
    best = tun.best_trials(res, SPEC).collect()
    assert len(best) == 2 and all(r.label == "day" for r in best)  # a clean daily cycle favours the daily season


def test_dhr_and_learned_trials(spark):
    s = _series(spark)
    d = tun.dhr_trials(s, SPEC, SPLIT, [("a", DhrConfig(p=1, q=0, daily_terms=1, weekly_terms=0)), ("b", DhrConfig(p=1, q=1, daily_terms=2, weekly_terms=0))])
    rows = d.collect()
    assert len(rows) == 4 and all(r.val_MAE > 0 and r.params["p"] == "1" for r in rows)
    lt = tun.learned_trials(s, SPEC, SPLIT, [("r3", {"recent": 3}), ("r6", {"recent": 6})])
    assert {r.label for r in lt.collect()} == {"r3", "r6"}
