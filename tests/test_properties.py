"""Window operators against brute-force pandas on random small fixtures."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridseries.config import SeriesSpec
from gridseries.operators import anomalies as an
from gridseries.operators import forecast as fc
from gridseries.operators import series as ser

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
T0 = datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.floats(min_value=-50, max_value=50, allow_nan=False).map(lambda x: round(x, 2))), min_size=1, max_size=30)


def _df(spark, vals, present=None):
    rows = [(1, T0 + timedelta(hours=i), v) for i, v in enumerate(vals) if present is None or present[i]]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double")


@SETTINGS
@given(vals=values)
def test_interpolate_matches_pandas(spark, vals):
    out = [r.v for r in ser.interpolate(_df(spark, vals), SPEC).orderBy("ts").collect()]
    ref = pd.Series(vals, dtype=float).interpolate(limit_direction="both").tolist()
    for a, b in zip(out, ref):
        assert (a is None and np.isnan(b)) or abs(a - b) < 1e-9


@SETTINGS
@given(vals=st.lists(st.sampled_from([10.0, 1.0, 0.0, 5.0]), min_size=5, max_size=40), period=st.integers(1, 5), run=st.integers(1, 4))
def test_drop_runs_match_loop(spark, vals, period, run):
    got = sorted((r.start, r.end) for r in an.drop_runs(_df(spark, vals), SPEC, period, 0.6, run).collect())
    s = pd.Series(vals, dtype=float)
    base = s.shift(period)
    rel = (s - base) / np.where(base.abs() < 1e-6, np.nan, base)
    flagged = (rel < -0.6).to_numpy()
    ref, start = [], None
    for i, f in enumerate(flagged):
        if f and start is None:
            start = i
        elif not f and start is not None:
            if i - start >= run:
                ref.append((start, i - 1))
            start = None
    if start is not None and len(flagged) - start >= run:
        ref.append((start, len(flagged) - 1))
    assert got == [(T0 + timedelta(hours=a), T0 + timedelta(hours=b)) for a, b in ref]


@SETTINGS
@given(
    vals=st.lists(st.floats(min_value=0, max_value=100, allow_nan=False).map(lambda x: round(x, 1)), min_size=2, max_size=40),
    mask=st.lists(st.booleans(), min_size=40, max_size=40),
    period=st.integers(1, 6),
)
def test_baselines_match_lookups_with_gaps(spark, vals, mask, period):
    present = [m or i == 0 for i, m in enumerate(mask[: len(vals)])]
    f = fc.baseline_forecasts(_df(spark, vals, present), SPEC, {"last": None, "seas": period}).collect()
    hist = {T0 + timedelta(hours=i): v for i, v in enumerate(vals) if present[i]}
    for r in f:
        past = [t for t in hist if t <= r.ts - timedelta(hours=1)]
        last = hist[max(past)] if past else None
        if r.model == "last":
            assert r.y_pred == last
        else:
            key = r.ts - timedelta(hours=period)
            assert r.y_pred == (hist[key] if key in hist else last)


@SETTINGS
@given(seed=st.integers(0, 10_000), lags=st.integers(0, 6), n=st.integers(100, 220))
def test_sql_kpss_and_acf_match_numpy_kernels(spark, seed, lags, n):
    from gridseries.kernels import correlation, stationarity
    from gridseries.operators import correlation as cor

    rng = np.random.default_rng(seed)
    x = np.cumsum(rng.normal(size=n)) * 0.3 + rng.normal(size=n)
    df = _df(spark, [round(float(v), 6) for v in x])
    xs = np.array([round(float(v), 6) for v in x])
    k = cor.kpss_fixed_lag(df, SPEC, lags).first()
    ref = stationarity.kpss(xs, lags)
    assert abs(k.kpss_stat - ref["statistic"]) < 1e-9 * max(1.0, abs(ref["statistic"]))
    assert abs(k.kpss_pvalue - ref["pvalue"]) < 1e-12
    a = {r.lag: r.acf for r in cor.acf_at_lags(df, SPEC, [1, 5, 24]).collect()}
    r, _ = correlation.acf(xs, 24)
    for lag in (1, 5, 24):
        assert abs(a[lag] - r[lag]) < 1e-9


@SETTINGS
@given(seed=st.integers(0, 10_000), period=st.sampled_from([4, 5, 6, 7]), n=st.integers(30, 60))
def test_classical_decomposition_matches_pandas(spark, seed, period, n):
    from gridseries.operators import decomposition as dec

    rng = np.random.default_rng(seed)
    x = np.round(10 + np.sin(2 * np.pi * np.arange(n) / period) * 3 + rng.normal(size=n), 3)
    got = dec.classical_decompose(_df(spark, list(map(float, x))), SPEC, period).orderBy("ts").collect()
    s = pd.Series(x)
    if period % 2:
        trend = s.rolling(period, center=True).mean()
    else:
        w = np.r_[0.5, np.ones(period - 1), 0.5] / period
        trend = s.rolling(period + 1, center=True).apply(lambda a: float(np.dot(a, w)), raw=True)
    phase = np.arange(n) % period
    pm = (s - trend).groupby(phase).mean()
    seasonal = (pm - pm.mean()).to_numpy()[phase]
    for r, t, se in zip(got, trend.to_numpy(), seasonal):
        assert (r.trend is None and np.isnan(t)) or abs(r.trend - t) < 1e-9
        assert abs(r.seasonal - se) < 1e-9


@SETTINGS
@given(seed=st.integers(0, 10_000), spike_at=st.integers(8, 30))
def test_joint_failure_matches_pandas(spark, seed, spike_at):
    from gridseries.operators import evaluate as ev

    rng = np.random.default_rng(seed)
    n, window, mult = 40, 6, 2.0
    y = rng.uniform(50, 60, size=n)
    preds = {m: y + rng.normal(scale=1.0, size=n) for m in ("m1", "m2")}
    for m in preds:
        preds[m][spike_at : spike_at + 4] += rng.uniform(8, 15)
    rows = [(m, 1, T0 + timedelta(hours=i), float(y[i]), float(p[i])) for m, p in preds.items() for i in range(n)]
    df = spark.createDataFrame(rows, "model string, id int, ts timestamp_ntz, y_true double, y_pred double")
    got = ev.joint_failure(df, SPEC, window, mult, n_models=2).collect()
    roll, avg = {}, {}
    for m, p in preds.items():
        ae = pd.Series(np.abs(y - p))
        roll[m], avg[m] = ae.rolling(window, min_periods=window).mean(), ae.mean()
    joint = np.logical_and.reduce([(roll[m] > avg[m] * mult).to_numpy() for m in preds])
    if not joint.any():
        assert got == []
        return
    ratio = {m: roll[m] / max(avg[m], 1e-9) for m in preds}
    sev = sum(ratio[m] for m in preds).where(joint, -np.inf)
    peak = int(np.argmax(sev.to_numpy()))
    assert len(got) == 1 and got[0].peak == T0 + timedelta(hours=peak)
    for m in preds:
        assert abs(got[0].ratios[m] - ratio[m].iloc[peak]) < 1e-9


@SETTINGS
@given(vals=st.lists(st.floats(min_value=-50, max_value=50, allow_nan=False).map(lambda x: round(x, 2)), min_size=1, max_size=30), w=st.integers(1, 6))
def test_rolling_windows_match_pandas(spark, vals, w):
    from gridseries.operators import windows as win

    out = win.moving_average(win.rolling_stats(_df(spark, vals), SPEC, w), SPEC, w).orderBy("ts").collect()
    s = pd.Series(vals, dtype=float)
    mean, std = s.rolling(w, min_periods=w).mean(), s.rolling(w, min_periods=w).std()
    ma = s.rolling(w, min_periods=1).mean()
    for r, a, b, c in zip(out, mean, std, ma):
        assert (r.rolling_mean is None and np.isnan(a)) or abs(r.rolling_mean - a) < 1e-9
        assert (r.rolling_std is None and np.isnan(b)) or abs(r.rolling_std - b) < 1e-9
        assert abs(r.moving_avg - c) < 1e-9


@SETTINGS
@given(totals=st.lists(st.floats(min_value=0.5, max_value=1e6, allow_nan=False), min_size=3, max_size=40))
def test_kde_matches_direct_sum(spark, totals):
    from gridseries.operators import distribution as dist

    df = spark.createDataFrame([(i, float(t)) for i, t in enumerate(totals)], "id int, total double")
    got = {r.point: r.density for r in dist.kde(df, points=50).collect()}
    x = np.log10(np.asarray(totals))
    h = x.std(ddof=1) * len(x) ** (-0.2)
    if not h > 0:
        assert all(v is None for v in got.values())
        return
    grid = np.linspace(x.min(), x.max(), 50)
    ref = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    for j in range(50):
        assert abs(got[j] - ref[j]) <= 1e-9 * max(1.0, ref[j])
