"""Unit-root and stationarity tests on one series (numpy only).

ADF with constant + trend and AIC lag selection, KPSS (trend) with the
automatic Bartlett bandwidth, and the p-value formulas they report.
"""

from __future__ import annotations

import math

import numpy as np

MIN_OBS = 100

# MacKinnon (1994) response-surface coefficients for the
# constant + trend ADF statistic with one variable, as effective polynomial
# coefficients in tau (lowest order first), and the branch limits.
ADF_CT_SMALL_P = (3.2512, 1.6047, 0.049588)
ADF_CT_LARGE_P = (2.5261, 0.61654, -0.37956, -0.060285)
ADF_CT_TAU_MAX = 0.70
ADF_CT_TAU_MIN = -16.18
ADF_CT_TAU_STAR = -2.89

# KPSS trend critical values and p-values.
KPSS_CT_CRIT = (0.119, 0.146, 0.176, 0.216)
KPSS_CT_PVAL = (0.10, 0.05, 0.025, 0.01)


def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def adf_pvalue(tau: float) -> float:
    """MacKinnon approximate p-value for the constant + trend ADF statistic."""
    if not np.isfinite(tau):
        return float("nan")
    if tau > ADF_CT_TAU_MAX:
        return 1.0
    if tau < ADF_CT_TAU_MIN:
        return 0.0
    coef = ADF_CT_SMALL_P if tau <= ADF_CT_TAU_STAR else ADF_CT_LARGE_P
    z = sum(c * tau**i for i, c in enumerate(coef))
    return norm_cdf(z)


def _adf_design(x: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows t: dx_t on [x_{t-1}, dx_{t-1..t-lags}], keeping the last n-1-lags rows."""
    dx = np.diff(x)
    nobs = dx.shape[0] - lags
    cols = [x[lags : lags + nobs]]  # level x_{t-1}
    for k in range(1, lags + 1):
        cols.append(dx[lags - k : lags - k + nobs])
    return dx[lags:], np.column_stack(cols)


def adf(x: np.ndarray, maxlag: int | None = None) -> dict:
    """Augmented Dickey-Fuller test, regression with constant and linear trend.

    The lag order minimises AIC over 0..maxlag on a common sample; the
    statistic is the t-value of the level coefficient in the refit with the
    chosen lag. Fewer than 100 observations → NaN.
    """
    x = np.asarray(x, dtype=float)
    x = x[np.isfinite(x)]
    n = x.shape[0]
    nan = {"statistic": float("nan"), "pvalue": float("nan"), "usedlag": float("nan"), "nobs": float("nan")}
    if n < MIN_OBS:
        return nan
    if maxlag is None:
        maxlag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
        maxlag = min(n // 2 - 3, maxlag)
    if maxlag < 0:
        return nan
    # AIC search: same sample for every lag; columns const, trend, level, lags
    y, xd = _adf_design(x, maxlag)
    m = y.shape[0]
    full = np.column_stack([np.ones(m), np.arange(1, m + 1, dtype=float), xd])
    q, r = np.linalg.qr(full)
    qy = q.T @ y
    yy = float(y @ y)
    ssr = yy - np.cumsum(qy * qy)
    best = None
    for lag in range(0, maxlag + 1):
        k = 3 + lag
        s = max(ssr[k - 1], 1e-300)
        aic = m * (math.log(2 * math.pi) + math.log(s / m) + 1) + 2 * k
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = best[1]
    y, xd = _adf_design(x, lag)
    m = y.shape[0]
    design = np.column_stack([xd, np.ones(m), np.arange(1, m + 1, dtype=float)])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    resid = y - design @ beta
    k = design.shape[1]
    sigma2 = float(resid @ resid) / (m - k)
    cov = sigma2 * np.linalg.pinv(design.T @ design)
    tau = float(beta[0] / math.sqrt(cov[0, 0]))
    return {"statistic": tau, "pvalue": adf_pvalue(tau), "usedlag": float(lag), "nobs": float(m)}


def kpss_pvalue(stat: float) -> float:
    return float(np.interp(stat, KPSS_CT_CRIT, KPSS_CT_PVAL))


def _trend_resid(x: np.ndarray) -> np.ndarray:
    n = x.shape[0]
    design = np.column_stack([np.ones(n), np.arange(1, n + 1, dtype=float)])
    beta, *_ = np.linalg.lstsq(design, x, rcond=None)
    return x - design @ beta


def lag_products(e: np.ndarray, most: int) -> np.ndarray:
    """Sums of e_t e_{t-k} for k = 0..most."""
    return np.array([e[k:] @ e[: len(e) - k] for k in range(most + 1)])


def kpss_autolag(resid: np.ndarray) -> int:
    """Data-dependent Bartlett bandwidth (Hobijn, Franses and Ooms 1998) from the first n^(2/9) lag products."""
    n = len(resid)
    p = lag_products(resid, int(n ** (2.0 / 9.0))) / n
    level, slope = p[0] + 2 * p[1:].sum(), 2 * (np.arange(len(p)) * p).sum()
    return int(1.1447 * ((slope / level) ** 2 * n) ** (1.0 / 3.0))


def kpss(x: np.ndarray, lags: int | None = None) -> dict:
    """KPSS test of trend stationarity; ``lags=None`` picks the bandwidth
    automatically. Fewer than 100 observations or a failure → NaN."""
    x = np.asarray(x, dtype=float)
    x = x[np.isfinite(x)]
    n = x.shape[0]
    if n < MIN_OBS:
        return {"statistic": float("nan"), "pvalue": float("nan"), "lags": float("nan")}
    try:
        e = _trend_resid(x)
        nl = kpss_autolag(e) if lags is None else int(lags)
        nl = min(nl, n - 1)
        eta = float(np.sum(np.cumsum(e) ** 2)) / (n * n)
        weights = 2.0 * (1.0 - np.arange(nl + 1) / (nl + 1.0))
        weights[0] = 1.0
        stat = eta / float(weights @ lag_products(e, nl) / n)
    except (ValueError, ZeroDivisionError, np.linalg.LinAlgError):
        return {"statistic": float("nan"), "pvalue": float("nan"), "lags": float("nan")}
    return {"statistic": stat, "pvalue": kpss_pvalue(stat), "lags": float(nl)}
