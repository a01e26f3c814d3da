from datetime import datetime, timedelta

import numpy as np

from gridseries.config import DhrConfig, SeriesSpec, Split
from gridseries.operators import evaluate as ev
from gridseries.operators import forecast as fc
from gridseries.operators import grouped as gm
from gridseries.operators import lagged

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
T0 = datetime(2024, 1, 1)
SPLIT = Split(T0, datetime(2024, 1, 28, 23), datetime(2024, 1, 29), datetime(2024, 1, 31, 23), datetime(2024, 2, 1), datetime(2024, 2, 7, 23))


def synthetic(spark, n_entities=3, days=38):
    # level + daily and weekly sines + AR(1) noise
    rng = np.random.default_rng(7)
    data = []
    for e in range(n_entities):
        ar = 0.0
        for i in range(24 * days):
            ar = 0.6 * ar + rng.normal(scale=2.0)
            v = 100 + 10 * e + 20 * np.sin(2 * np.pi * i / 24) + 8 * np.sin(2 * np.pi * i / 168) + ar
            data.append((e, T0 + timedelta(hours=i), float(v)))
    return spark.createDataFrame(data, "id int, ts timestamp_ntz, v double")


def test_dhr_beats_naive_on_synthetic_truth(spark):
    s = synthetic(spark)
    f = gm.dhr_forecasts(s, SPEC, SPLIT, DhrConfig(p=1, q=1, daily_terms=2, weekly_terms=2))
    f = f.unionByName(fc.baseline_forecasts(s, SPEC))
    m = ev.metrics_table(ev.walk_forward(f, SPEC, SPLIT.test_start, SPLIT.test_end), SPEC).collect()
    by = {}
    for r in m:
        by.setdefault(r.id, {})[r.model] = r.MAE
    for e, models in by.items():
        assert models["dhr"] < min(v for k, v in models.items() if k != "dhr")


def test_stationarity_and_stl_tables(spark):
    s = synthetic(spark, 2, 20)
    t = lagged.stationarity_tests(s, SPEC).collect()
    assert len(t) == 2 and all(r.n_obs == 480 and r.kpss_pvalue >= 0.05 for r in t)
    assert all(0.0 <= r.adf_pvalue <= 1.0 for r in t)
    d = gm.stl_decompose(s, SPEC, 24)
    assert d.count() == 2 * 24 * 20
    from gridseries.operators.decomposition import strengths

    st = strengths(d, SPEC).collect()
    assert all(r.seasonal_strength > 0.8 for r in st)


def test_acf_pacf_tables(spark):
    s = synthetic(spark, 1, 10)
    a = {r.lag: r.acf for r in lagged.acf_table(s, SPEC, 48).collect()}
    assert a[0] == 1.0 and a[24] > 0.5
    p = lagged.pacf_table(s, SPEC, 10).collect()
    assert len(p) == 11
