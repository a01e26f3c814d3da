from datetime import datetime, timedelta

from gridseries.config import SeriesSpec
from gridseries.operators import anomalies as an
from gridseries.operators import decomposition as dec

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")


def _df(spark, values):
    t0 = datetime(2024, 1, 1)
    return spark.createDataFrame([(1, t0 + timedelta(hours=i), float(v)) for i, v in enumerate(values)], "id int, ts timestamp_ntz, v double")


def test_drop_runs(spark):
    # F8: baseline one period earlier is always 10; a run of 5 (not reported),
    # a run of 6 (reported) and a run open at the series end (reported)
    period = 40
    vals = [10.0] * period + [1.0] * 5 + [10.0] * 3 + [1.0] * 6 + [10.0] * 3 + [1.0] * 7
    out = an.drop_runs(_df(spark, vals), SPEC, period, 0.6, 6).orderBy("start").collect()
    assert [r.length for r in out] == [6, 7]
    assert out[1].end == datetime(2024, 1, 1) + timedelta(hours=len(vals) - 1)
    assert abs(out[0].mean_relative_drop - (-0.9)) < 1e-9


def test_zero_baseline_never_flags(spark):
    vals = [0.0, 0.0] + [0.0] * 10
    assert an.drop_runs(_df(spark, vals), SPEC, 2, 0.6, 1).count() == 0


def test_classical_decomposition_parts_sum_and_outlier(spark):
    import math

    vals = [10 + 5 * math.sin(2 * math.pi * i / 24) for i in range(24 * 8)]
    vals[100] += 50.0
    d = dec.classical_decompose(_df(spark, vals), SPEC, 24)
    for r in d.where("trend IS NOT NULL").collect():
        assert abs(r.observed - (r.trend + r.seasonal + r.resid)) < 1e-9
    s = dec.strengths(d, SPEC).first()
    assert s.seasonal_strength > 0.5
    o = an.residual_outliers(d, SPEC, 4.0).collect()
    assert [r.ts for r in o] == [datetime(2024, 1, 1) + timedelta(hours=100)]
