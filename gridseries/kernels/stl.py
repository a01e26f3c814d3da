"""Seasonal-trend decomposition by LOESS (Cleveland et al., 1990), numpy only.

Follows the published algorithm: an inner loop of cycle-subseries LOESS,
low-pass filter and trend LOESS, and an outer loop of bisquare robustness
weights. Defaults: seasonal window 7, trend window the smallest odd integer
>= 1.5 p / (1 - 1.5 / seasonal), low-pass window the smallest odd integer
> p, all local-linear, no jumps; robust = 2 inner x (15 + 1) outer passes.
"""

from __future__ import annotations

import functools
import math

import numpy as np



def _odd(v: int) -> int:
    return v if v % 2 == 1 else v + 1


def default_windows(period: int, seasonal: int = 7) -> tuple[int, int, int]:
    seasonal = _odd(max(3, seasonal))
    trend = _odd(int(math.ceil(1.5 * period / (1.0 - 1.5 / seasonal))))
    low_pass = _odd(period + 1)
    return seasonal, trend, low_pass


def _est(y, n, length, xs, nleft, nright, rw):
    """Local linear LOESS estimates at positions ``xs`` (1-based, floats).

    ``y`` is (batch, n) and ``rw`` None or (batch, n); the neighbourhoods
    ``nleft``/``nright`` (1-based, equal widths) are shared by the batch.
    Returns (estimates (batch, len(xs)), ok mask).
    """
    width = int(nright[0] - nleft[0] + 1)
    ipos = nleft.astype(np.int64)[:, None] + np.arange(width)[None, :]  # 1-based
    pos = ipos.astype(float)
    r = np.abs(pos - xs[:, None])
    h = np.maximum(xs - nleft, nright - xs)
    if length > n:
        h = h + (length - n) // 2
    h = h[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.where(r <= 0.999 * h, np.where(r <= 0.001 * h, 1.0, (1.0 - (r / h) ** 3) ** 3), 0.0)
    w = np.broadcast_to(w, (y.shape[0],) + w.shape)
    if rw is not None:
        w = w * rw[:, ipos - 1]
    a = w.sum(axis=2)
    ok = a > 0
    w = w / np.where(ok, a, 1.0)[:, :, None]
    mean = (w * pos).sum(axis=2)
    b = xs[None, :] - mean
    dev = pos[None, :, :] - mean[:, :, None]
    c = (w * dev * dev).sum(axis=2)
    adj = (h[None, :, 0] > 0) & (np.sqrt(c) > 0.001 * (n - 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(adj, b / np.where(c > 0, c, 1.0), 0.0)
    w = w * (slope[:, :, None] * dev + 1.0)
    ys = (w * y[:, ipos - 1]).sum(axis=2)
    return ys, ok


def _loess_all(y: np.ndarray, length: int, rw: np.ndarray | None) -> np.ndarray:
    """Smooth every point of each row of ``y`` (batch, n) with a ``length``-point window."""
    n = y.shape[1]
    if n < 2:
        return y.copy()
    out = np.empty_like(y)
    if length < n:
        # interior points share one symmetric kernel: sliding sums in C
        nsh = (length + 1) // 2
        lo, hi = nsh - 1, n - nsh + 1  # 0-based rows with a centred window
        for b in range(y.shape[0]):
            out[b, lo:hi] = _interior(y[b], rw[b] if rw is not None else None, nsh - 1, n)
    for rows, start, k0, k1, k2, slope_ok in _window_kernels(n, length):
        width = k0.shape[1]
        yw = y[:, start : start + width]
        v = np.ones_like(yw) if rw is None else rw[:, start : start + width]
        vy = v * yw
        s0 = v @ k0.T
        s1 = v @ k1.T
        s2 = v @ k2.T
        t0 = vy @ k0.T
        t1 = vy @ k1.T
        ok = s0 > 0
        a = np.where(ok, s0, 1.0)
        m = s1 / a
        c = s2 / a - m * m
        adj = slope_ok[None, :] & (np.sqrt(np.maximum(c, 0.0)) > 0.001 * (n - 1))
        slope = np.where(adj, -m / np.where(c > 0, c, 1.0), 0.0)
        ys = t0 / a + slope * (t1 / a - m * t0 / a)
        out[:, rows] = np.where(ok, ys, y[:, rows])
    return out


@functools.lru_cache(maxsize=8)
def _window_kernels(n: int, length: int):
    """Tricube kernels of the rows whose window is not centred.

    Those rows share one window (the first or last ``length`` points, or the
    whole series when ``length >= n``), so their kernels depend only on
    (n, length): computed once and reused by every pass and series. Each
    entry: (rows, window start, K, K*d, K*d^2, slope allowed) with d the
    offset from the fitted position.
    """
    out = []
    if length >= n:
        groups = [(np.arange(n), 1, n)]
    else:
        nsh = (length + 1) // 2
        groups = [(np.arange(0, nsh - 1), 1, length), (np.arange(n - nsh + 1, n), n - length + 1, n)]
    for rows, nleft, nright in groups:
        if rows.size == 0:
            continue
        xs = rows + 1.0
        pos = np.arange(nleft, nright + 1, dtype=float)
        d = pos[None, :] - xs[:, None]
        h = np.maximum(xs - nleft, nright - xs)
        if length > n:
            h = h + (length - n) // 2
        hh = h[:, None]
        r = np.abs(d)
        with np.errstate(divide="ignore", invalid="ignore"):
            k = np.where(r <= 0.999 * hh, np.where(r <= 0.001 * hh, 1.0, (1.0 - (r / hh) ** 3) ** 3), 0.0)
        out.append((rows, nleft - 1, k, k * d, k * d * d, h > 0))
    return tuple(out)


def _interior(y: np.ndarray, rw: np.ndarray | None, h: int, n: int) -> np.ndarray:
    """Local linear fit at rows h .. n-h-1 with a centred window of half-width h.

    Same estimate as ``_est`` (tricube weights times robustness weights,
    slope term only when the weighted spread is large enough), written as
    sliding weighted sums so the cost is a few correlations.
    """
    d = np.arange(-h, h + 1, dtype=float)
    r = np.abs(d)
    k = np.where(r <= 0.999 * h, np.where(r <= 0.001 * h, 1.0, (1.0 - (r / h) ** 3) ** 3), 0.0)
    wv = np.ones(n) if rw is None else rw
    s0 = np.correlate(wv, k, "valid")
    s1 = np.correlate(wv, k * d, "valid")
    s2 = np.correlate(wv, k * d * d, "valid")
    t0 = np.correlate(wv * y, k, "valid")
    t1 = np.correlate(wv * y, k * d, "valid")
    ok = s0 > 0
    a = np.where(ok, s0, 1.0)
    m = s1 / a
    c = s2 / a - m * m
    adj = np.sqrt(np.maximum(c, 0.0)) > 0.001 * (n - 1)
    slope = np.where(adj, -m / np.where(c > 0, c, 1.0), 0.0)
    ys = t0 / a + slope * (t1 / a - m * t0 / a)
    return np.where(ok, ys, y[h : n - h])


def _moving_average(x: np.ndarray, length: int) -> np.ndarray:
    c = np.cumsum(np.concatenate([[0.0], x]))
    return (c[length:] - c[:-length]) / length


def _cycle_subseries(y, period, ns, rw):
    """Smooth each phase's subseries and extend it one period at each end.

    Phases with the same subseries length are smoothed as one batch.
    """
    n = y.shape[0]
    out = np.zeros(n + 2 * period)
    lengths = (n - 1 - np.arange(period)) // period + 1
    for k in np.unique(lengths):
        phases = np.nonzero(lengths == k)[0]
        idx = phases[:, None] + period * np.arange(k)[None, :]
        sub = y[idx]
        w = rw[idx] if rw is not None else None
        sm = np.empty((phases.shape[0], k + 2))
        sm[:, 1 : k + 1] = _loess_all(sub, ns, w)
        if k == 1:
            sm[:, 0] = sm[:, 1]
            sm[:, 2] = sm[:, 1]
        else:
            width = min(ns, k)
            left, ok = _est(sub, k, ns, np.array([0.0]), np.array([1.0]), np.array([float(width)]), w)
            sm[:, 0] = np.where(ok[:, 0], left[:, 0], sm[:, 1])
            right, ok = _est(sub, k, ns, np.array([k + 1.0]), np.array([float(k - width + 1)]), np.array([float(k)]), w)
            sm[:, k + 1] = np.where(ok[:, 0], right[:, 0], sm[:, k])
        out[phases[:, None] + period * np.arange(k + 2)[None, :]] = sm
    return out


def _robustness_weights(y, fit):
    r = np.abs(y - fit)
    cmad = 6.0 * np.median(r)
    if cmad <= 0:
        return np.ones_like(r)
    u = r / cmad
    return np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - u * u) ** 2, 0.0))


def stl(
    y: np.ndarray,
    period: int,
    seasonal: int = 7,
    trend: int | None = None,
    low_pass: int | None = None,
    robust: bool = True,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return (seasonal, trend, resid) of ``y`` (no NaN allowed)."""
    y = np.asarray(y, dtype=float)
    n = y.shape[0]
    if period < 2 or n < 2 * period:
        raise ValueError(f"STL needs period >= 2 and at least two periods, got n={n}, period={period}")
    ns, nt, nl = default_windows(period, seasonal)
    nt = _odd(trend) if trend else nt
    nl = _odd(low_pass) if low_pass else nl
    inner, outer = (2, 15) if robust else (5, 0)
    season = np.zeros(n)
    tr = np.zeros(n)
    rw = None
    for k in range(outer + 1):
        for _ in range(inner):
            c = _cycle_subseries(y - tr, period, ns, rw)
            lp = _moving_average(_moving_average(_moving_average(c, period), period), 3)
            lp = _loess_all(lp[None, :], nl, None)[0]
            season = c[period : period + n] - lp
            tr = _loess_all((y - season)[None, :], nt, None if rw is None else rw[None, :])[0]
        if k < outer:
            rw = _robustness_weights(y, season + tr)
    return season, tr, y - season - tr
