"""Chunked correlograms and tests against the numpy kernels on whole series."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from gridseries.config import SeriesSpec
from gridseries.kernels import correlation, stationarity
from gridseries.operators import chunks, lagged

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
T0 = datetime(2024, 1, 1)


def make():
    rng = np.random.default_rng(11)
    out = {}
    walk = np.cumsum(rng.normal(size=900)) + 50
    out["walk"] = walk
    out["trend"] = 0.02 * np.arange(700) + rng.normal(size=700) + 1e4
    out["season"] = 10 + 3 * np.sin(np.arange(500) / 24 * 2 * np.pi) + rng.normal(size=500) * 0.2
    gaps = rng.normal(size=600)
    gaps[rng.random(600) < 0.3] = np.nan
    out["gaps"] = gaps
    out["short"] = rng.normal(size=60)
    out["constant"] = np.full(150, 4.0)
    out["one"] = np.array([3.0])
    out["none"] = np.array([np.nan, np.nan])
    return out


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    data = []
    for name, x in make().items():
        hours = np.cumsum(1 + (rng.random(len(x)) < 0.05) * rng.integers(1, 40, len(x)))
        data += [(None if name == "season" else name, T0 + timedelta(hours=int(h)), None if np.isnan(v) else float(v)) for h, v in zip(hours, x, strict=True)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "id string, ts timestamp_ntz, v double").cache()


@pytest.fixture(params=[64, 4096])
def chunk_steps(request, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_STEPS", request.param)
    return request.param


def key(name):
    return None if name == "season" else name


def close(a, b, tol=1e-7):
    return (a is not None and np.isnan(a) and np.isnan(b)) or abs(a - b) <= tol * max(1, abs(b))


def test_positions(spark, series, chunk_steps):
    rows = chunks.placed(series, SPEC).collect()
    for name, x in make().items():
        own = sorted((r for r in rows if r.id == key(name)), key=lambda r: r.ts)
        assert [r._pos for r in own] == list(range(len(x)))


def test_one_series_is_many_chunks(spark, series, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_STEPS", 64)
    placed = chunks.placed(series.where("id = 'walk'"), SPEC)
    sizes = [r["count"] for r in chunks.with_halo(placed, 10).groupBy("id", chunks.CHUNK).count().collect()]
    assert len(sizes) == 15 and max(sizes) == 74


def test_acf_and_pacf(spark, series, chunk_steps):
    acf = lagged.acf_table(series, SPEC, 200).collect()
    pacf = lagged.pacf_table(series, SPEC, 60).collect()
    for name, x in make().items():
        r, band = correlation.acf(x, 200)
        got = sorted((a for a in acf if a.id == key(name)), key=lambda a: a.lag)
        assert [a.lag for a in got] == list(range(len(r)))
        assert all(close(a.acf, r[a.lag]) and close(a.band, band[a.lag]) for a in got)
        n = int(np.isfinite(x).sum())
        if n:
            p, half = correlation.pacf_yw(x, max(0, min(60, n // 2 - 1)))
            got = sorted((a for a in pacf if a.id == key(name)), key=lambda a: a.lag)
            assert [a.lag for a in got] == list(range(len(p)))
            assert all(close(a.pacf, p[a.lag], 1e-6) and close(a.band, half) for a in got)


@pytest.mark.parametrize("lags", [None, 5])
def test_tests_equal_kernels(spark, series, chunk_steps, lags):
    got = {r.id: r for r in lagged.stationarity_tests(series, SPEC, lags, (1, 24)).collect()}
    assert len(got) == len(make())
    for name, x in make().items():
        r, finite = got[key(name)], x[np.isfinite(x)]
        assert r.n_obs == len(finite)
        if name == "constant":  # no variance: no statistic, rather than one made of rounding residue
            assert np.isnan(r.adf_stat) and np.isnan(r.kpss_stat)
            continue
        # the statistic does not depend on the level, but the kernel's normal equations lose it at a level of 1e4
        a, k = stationarity.adf(x - np.nanmean(x)), stationarity.kpss(x, lags)
        assert close(r.adf_stat, a["statistic"], 1e-6) and close(r.adf_pvalue, a["pvalue"], 1e-6)
        assert close(r.adf_usedlag, a["usedlag"]) and close(r.adf_nobs, a["nobs"])
        assert close(r.kpss_stat, k["statistic"]) and close(r.kpss_pvalue, k["pvalue"]) and close(r.kpss_lags, k["lags"])
        for d in (1, 24):
            diff = stationarity.adf((x[d:] - x[:-d])[np.isfinite(x[d:] - x[:-d])] if d < len(x) else np.array([]))
            stat = r[f"adf_stat_diff{d}"]
            assert close(float("nan") if stat is None else stat, diff["statistic"], 1e-6)


def test_empty_table(spark, series, chunk_steps):
    empty = series.limit(0)
    assert lagged.acf_table(empty, SPEC, 10).count() == lagged.pacf_table(empty, SPEC).count() == lagged.stationarity_tests(empty, SPEC).count() == 0
