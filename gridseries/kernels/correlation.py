"""Autocorrelation and partial autocorrelation of one series (numpy only)."""

from __future__ import annotations

import math

import numpy as np

Z975 = 1.959963984540054  # standard normal 97.5 % quantile


def acf(x: np.ndarray, nlags: int) -> tuple[np.ndarray, np.ndarray]:
    """Sample ACF by FFT (biased autocovariance) and its 95 % Bartlett half-width.

    Lags 0..min(nlags, n-1); NaN values are dropped first.
    """
    x = np.asarray(x, dtype=float)
    x = x[np.isfinite(x)]
    n = x.shape[0]
    if n < 2:
        return np.full(1, np.nan), np.full(1, np.nan)
    nlags = int(min(nlags, n - 1))
    d = x - x.mean()
    size = 1 << int(math.ceil(math.log2(2 * n)))
    f = np.fft.rfft(d, n=size)
    acov = np.fft.irfft(f * np.conj(f), n=size)[:n] / n
    r = acov[: nlags + 1] / acov[0] if acov[0] > 0 else np.full(nlags + 1, np.nan)
    var = np.ones(nlags + 1) / n
    var[0] = 0.0
    if nlags >= 2:
        var[2:] *= 1 + 2 * np.cumsum(r[1:-1] ** 2)
    return r, Z975 * np.sqrt(var)


def pacf_yw(x: np.ndarray, nlags: int) -> tuple[np.ndarray, float]:
    """Partial autocorrelation by Yule-Walker with the biased autocovariance
    (Durbin-Levinson recursion on the sample ACF); 95 % half-width 1.96/sqrt(n)."""
    x = np.asarray(x, dtype=float)
    x = x[np.isfinite(x)]
    n = x.shape[0]
    r, _ = acf(x, nlags)
    return durbin_levinson(r), Z975 / math.sqrt(n)


def durbin_levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations at lags 0, 1, ..."""
    nlags = r.shape[0] - 1
    out = np.zeros(nlags + 1)
    out[0] = 1.0
    phi = np.zeros(nlags + 1)
    v = 1.0
    for k in range(1, nlags + 1):
        a = (r[k] - phi[1:k] @ r[k - 1 : 0 : -1]) / v
        new = phi.copy()
        new[1:k] = phi[1:k] - a * phi[k - 1 : 0 : -1]
        new[k] = a
        phi = new
        v *= 1 - a * a
        out[k] = a
    return out
