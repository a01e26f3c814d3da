import math

import numpy as np
import pytest

from gridseries.kernels import arma, correlation, stationarity, stl


def test_published_pvalue_formulas():
    # F13 goldens
    assert math.isclose(stationarity.adf_pvalue(-16.085087666180826), 1.11597964222196e-22, rel_tol=1e-9)
    assert math.isclose(stationarity.kpss_pvalue(0.1286950257482285), 0.08204624861439166, rel_tol=1e-12)
    assert stationarity.adf_pvalue(-17.0) == 0.0
    assert stationarity.adf_pvalue(0.8) == 1.0
    # branches meet near tau = -2.89
    assert abs(stationarity.adf_pvalue(-2.8901) - stationarity.adf_pvalue(-2.8899)) < 2e-3


def test_adf_and_kpss_separate_noise_from_random_walk():
    rng = np.random.default_rng(1)
    wn = rng.normal(size=1500)
    rw = np.cumsum(rng.normal(size=1500))
    assert stationarity.adf(wn)["pvalue"] < 0.01
    assert stationarity.adf(rw)["pvalue"] > 0.1
    assert stationarity.kpss(wn)["pvalue"] >= 0.05
    assert stationarity.kpss(rw)["pvalue"] == 0.01
    assert math.isnan(stationarity.adf(wn[:99])["statistic"])


def test_acf_matches_direct_sum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=300).cumsum()
    r, band = correlation.acf(x, 10)
    d = x - x.mean()
    direct = [float(d[: len(d) - k] @ d[k:] / (d @ d)) for k in range(11)]
    assert np.allclose(r, direct)
    assert band[0] == 0 and math.isclose(band[1], 1.959963984540054 / math.sqrt(300))


def test_pacf_of_ar1():
    rng = np.random.default_rng(3)
    e = rng.normal(size=5000)
    x = np.zeros_like(e)
    for i in range(1, len(e)):
        x[i] = 0.7 * x[i - 1] + e[i]
    p, _ = correlation.pacf_yw(x, 5)
    assert abs(p[1] - 0.7) < 0.05 and np.all(np.abs(p[2:]) < 0.06)


def test_stl_parts_and_strength():
    # F14-style synthetic truth
    rng = np.random.default_rng(4)
    t = np.arange(24 * 7 * 6)
    season = 5 * np.sin(2 * np.pi * t / 24)
    y = 50 + 0.02 * t + season + rng.normal(scale=0.5, size=t.size)
    y[200] += 8  # one spike, 16 noise sigmas
    s, tr, r = stl.stl(y, 24)
    assert np.allclose(s + tr + r, y)
    assert np.corrcoef(s, season)[0, 1] > 0.98
    z = (r - r.mean()) / r.std()
    assert np.argmax(np.abs(z)) == 200
    with pytest.raises(ValueError):
        stl.stl(y[:30], 24)


def test_stl_huge_spike_falls_back_like_the_published_algorithm():
    """A spike far above the noise leaks into neighbouring cycles on the first
    pass; their robustness weights drop to zero and the local fit at the spike
    has no weight left, so LOESS keeps the raw value (the published rule)."""
    rng = np.random.default_rng(4)
    t = np.arange(24 * 7 * 6)
    y = 50 + 5 * np.sin(2 * np.pi * t / 24) + rng.normal(scale=0.5, size=t.size)
    y[200] += 40
    s, tr, r = stl.stl(y, 24)
    assert np.allclose(s + tr + r, y)
    assert s[200] - s[176] > 30


def test_arma_recovers_parameters():
    rng = np.random.default_rng(5)
    n = 4000
    e = rng.normal(size=n)
    u = np.zeros(n)
    for i in range(2, n):
        u[i] = 0.5 * u[i - 1] - 0.2 * u[i - 2] + e[i] + 0.4 * e[i - 1]
    phi, theta, sigma2 = arma.fit_arma_css(u, 2, 1)
    assert np.allclose(phi, [0.5, -0.2], atol=0.08)
    assert abs(theta[0] - 0.4) < 0.08
    assert abs(sigma2 - 1.0) < 0.1


def test_one_step_forecasts_use_only_the_past():
    rng = np.random.default_rng(6)
    t = np.arange(600)
    x = arma.fourier_matrix(t, [(24, 2)])
    y = 3 + x @ np.array([1.0, 0.5, 0.2, 0.1]) + rng.normal(scale=0.3, size=t.size)
    par = arma.fit_regression_arma(y[:400], x[:400], 1, 1)
    a = arma.one_step_forecasts(y, x, par)
    y2 = y.copy()
    y2[500:] = 1e6
    b = arma.one_step_forecasts(y2, x, par)
    assert np.allclose(a[:501], b[:501])


def test_arima_d1_on_random_walk_with_cycle():
    rng = np.random.default_rng(8)
    t = np.arange(2000)
    x = arma.fourier_matrix(t, [(24, 2)])
    y = np.cumsum(rng.normal(size=t.size)) + x @ np.array([3.0, 1.0, 0.5, 0.2])
    par = arma.fit_regression_arma(y[:1500], x[:1500], 1, 0, d=1)
    pred = arma.one_step_forecasts(y, x, par)
    assert np.isnan(pred[0])
    mae = np.abs(y[1500:] - pred[1500:]).mean()
    naive = np.abs(np.diff(y)[1499:]).mean()
    assert mae < naive
    par0 = arma.fit_regression_arma(y[:1500], x[:1500], 1, 0, d=0)
    assert par0["d"] == 0 and par["d"] == 1
