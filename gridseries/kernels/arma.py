"""Regression with ARMA(p, q) errors for one series (numpy only).

Used by the dynamic harmonic regression forecaster: deterministic Fourier
regressors carry the daily / weekly cycle, an ARMA model carries the
short-term dependence of the remainder. Fitting is two-stage: OLS for the
regression, Hannan-Rissanen start for ARMA, then Gauss-Newton steps on the
conditional sum of squares. Forecasting is one linear recursion that yields
every one-step-ahead prediction, updating the state with each actual value
and never refitting.
"""

from __future__ import annotations

import math

import numpy as np


def fourier_matrix(steps: np.ndarray, periods_terms: list[tuple[int, int]]) -> np.ndarray:
    """Columns sin/cos(2 pi k s / period) for each (period, terms) pair."""
    s = np.asarray(steps, dtype=float)
    cols = []
    for period, terms in periods_terms:
        for k in range(1, terms + 1):
            cols.append(np.sin(2.0 * math.pi * k * s / period))
            cols.append(np.cos(2.0 * math.pi * k * s / period))
    if not cols:
        return np.zeros((s.shape[0], 0))
    return np.column_stack(cols)


def _filter(signals: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """out_t = signals_t - sum_j theta_j out_{t-j}, applied to each column.

    A sequential recursion: run on Python floats (same operation order as
    the vector form), which is far cheaper than per-step numpy scalars.
    """
    n, m = signals.shape
    th = [float(t) for t in theta]
    q = len(th)
    out = np.empty_like(signals, dtype=float)
    for c in range(m):
        s = signals[:, c].tolist()
        o = [0.0] * n
        for t in range(n):
            acc = s[t]
            for j in range(1, q + 1):
                if t - j >= 0:
                    acc -= th[j - 1] * o[t - j]
            o[t] = acc
        out[:, c] = o
    return out


def _lagged(u: np.ndarray, p: int) -> np.ndarray:
    n = u.shape[0]
    m = np.zeros((n, p))
    for i in range(1, p + 1):
        m[i:, i - 1] = u[:-i]
    return m


def css_residuals(u: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    e = u - _lagged(u, phi.shape[0]) @ phi if phi.shape[0] else u.copy()
    return _filter(e[:, None], theta)[:, 0] if theta.shape[0] else e


def hannan_rissanen(u: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    n = u.shape[0]
    if q == 0:
        if p == 0:
            return np.zeros(0), np.zeros(0)
        x = _lagged(u, p)[p:]
        phi, *_ = np.linalg.lstsq(x, u[p:], rcond=None)
        return phi, np.zeros(0)
    m = int(min(max(p + q + 5, round(10 * math.log10(n))), n // 4))
    x = _lagged(u, m)[m:]
    a, *_ = np.linalg.lstsq(x, u[m:], rcond=None)
    eps = np.zeros(n)
    eps[m:] = u[m:] - x @ a
    start = m + max(p, q)
    design = np.column_stack([_lagged(u, p)[start:], _lagged(eps, q)[start:]]) if p else _lagged(eps, q)[start:]
    coef, *_ = np.linalg.lstsq(design, u[start:], rcond=None)
    return coef[:p], coef[p:]


def _stable(theta: np.ndarray) -> bool:
    if theta.shape[0] == 0:
        return True
    roots = np.roots(np.concatenate([[1.0], theta]))
    return bool(np.all(np.abs(roots) < 0.999))


def fit_arma_css(u: np.ndarray, p: int, q: int, iterations: int = 20) -> tuple[np.ndarray, np.ndarray, float]:
    """ARMA(p, q) on a zero-mean series by conditional least squares."""
    phi, theta = hannan_rissanen(u, p, q)
    if not _stable(theta):
        theta = np.zeros(q)
    e = css_residuals(u, phi, theta)
    ssr = float(e @ e)
    for _ in range(iterations if p + q else 0):
        # d e_t / d phi_i = -(u_{t-i} filtered), d e_t / d theta_j = -(e_{t-j} filtered)
        raw = np.column_stack([_lagged(u, p), _lagged(e, q)]) if p + q else np.zeros((u.shape[0], 0))
        jac = -_filter(raw, theta) if q else -raw
        step, *_ = np.linalg.lstsq(jac, -e, rcond=None)
        lam = 1.0
        improved = False
        while lam > 1e-4:
            nphi = phi + lam * step[:p]
            ntheta = theta + lam * step[p:]
            if _stable(ntheta):
                ne = css_residuals(u, nphi, ntheta)
                nssr = float(ne @ ne)
                if np.isfinite(nssr) and nssr < ssr:
                    phi, theta, e, improved = nphi, ntheta, ne, True
                    gain = (ssr - nssr) / max(ssr, 1e-300)
                    ssr = nssr
                    break
            lam /= 2
        if not improved or gain < 1e-10:
            break
    return phi, theta, ssr / max(u.shape[0] - p - q, 1)


def fit_regression_arma(
    y: np.ndarray, x: np.ndarray, p: int, q: int, intercept: bool = True, iterations: int = 20, d: int = 0
) -> dict:
    """OLS of y on x (plus a constant), then ARMA(p, q) on the residual.

    With ``d = 1`` the model is fitted to the first differences of y and x
    (the constant becomes a drift), i.e. regression with ARIMA(p, 1, q) errors.
    """
    if d not in (0, 1):
        raise ValueError("d must be 0 or 1")
    if d == 1:
        par = fit_regression_arma(np.diff(y), np.diff(x, axis=0), p, q, intercept, iterations, 0)
        par["d"] = 1
        return par
    design = np.column_stack([x, np.ones(x.shape[0])]) if intercept else x
    ok = np.isfinite(y)
    beta, *_ = np.linalg.lstsq(design[ok], y[ok], rcond=None)
    u = y - design @ beta
    u = np.where(np.isfinite(u), u, 0.0)
    phi, theta, sigma2 = fit_arma_css(u, p, q, iterations)
    return {"beta": beta, "phi": phi, "theta": theta, "sigma2": sigma2, "intercept": intercept, "d": 0}


def one_step_forecasts(y: np.ndarray, x: np.ndarray, params: dict) -> np.ndarray:
    """Prediction of every y_t from y_{<t}: x_t beta + ARMA forecast of the remainder.

    A missing y_t contributes its own forecast and a zero innovation. With
    ``d = 1`` the differences are forecast and added to the previous value.
    """
    if int(params.get("d", 0)) == 1:
        inner = one_step_forecasts(np.diff(y), np.diff(x, axis=0), {**params, "d": 0})
        return np.concatenate([[np.nan], y[:-1] + inner])
    beta = np.asarray(params["beta"], dtype=float)
    phi = [float(v) for v in params["phi"]]
    theta = [float(v) for v in params["theta"]]
    design = np.column_stack([x, np.ones(x.shape[0])]) if params["intercept"] else x
    mean = (design @ beta).tolist()
    ys = np.asarray(y, dtype=float)
    finite = np.isfinite(ys).tolist()
    yl = ys.tolist()
    n = len(yl)
    p, q = len(phi), len(theta)
    u = [0.0] * n
    e = [0.0] * n
    pred = [0.0] * n
    for t in range(n):
        uh = 0.0
        for i in range(1, p + 1):
            if t - i >= 0:
                uh += phi[i - 1] * u[t - i]
        for j in range(1, q + 1):
            if t - j >= 0:
                uh += theta[j - 1] * e[t - j]
        pred[t] = mean[t] + uh
        if finite[t]:
            u[t] = yl[t] - mean[t]
            e[t] = u[t] - uh
        else:
            u[t] = uh
            e[t] = 0.0
    return np.asarray(pred)
