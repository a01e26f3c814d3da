"""Lag model search: coefficients and errors equal numpy's least squares on the same rows; the choice sees validation only."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from gridseries.config import SeriesSpec, Split
from gridseries.operators import search as sea

SPEC = SeriesSpec(entity="cell", ts="ts", value="value", step=3600, daily=24, weekly=168)
START = datetime(2024, 1, 1)
SPLIT = Split(
    train_start=START, train_end=START + timedelta(hours=299),
    val_start=START + timedelta(hours=300), val_end=START + timedelta(hours=379),
    test_start=START + timedelta(hours=380), test_end=START + timedelta(hours=420),
)
MODELS = [sea.LagModel("one", (1,)), sea.LagModel("two", (2, 1)), sea.LagModel("four", (1, 2, 3, 24)), sea.LagModel("ridge", (1, 2, 3, 24), 0.5)]
LAGS = [1, 2, 3, 24]


def _series(hours=420):
    rng = np.random.default_rng(0)
    noise = rng.normal(size=hours)
    y = np.zeros(hours)
    for t in range(hours):
        y[t] = 0.6 * y[t - 1] - 0.3 * y[t - 2] + noise[t] + 3 * np.sin(2 * np.pi * t / 24) if t > 1 else noise[t]
    return 50 + 4 * y


def _frame(spark, series):
    rows = [(c, START + timedelta(hours=t), None if v is None else float(v)) for c, y in series.items() for t, v in enumerate(y)]
    return spark.createDataFrame(rows, "cell string, ts timestamp_ntz, value double").repartition(5)


def _expected(y, model):
    z = (y - y[:300].mean()) / y[:300].std()
    cols = sorted(model.lags)
    x = np.array([[1.0, *(z[t - k] for k in cols)] for t in range(24, len(z))])
    train, val = slice(0, 276), slice(276, 356)
    ridge = np.diag([0.0, *[model.penalty * 276] * len(cols)])
    beta = np.linalg.solve(x[train].T @ x[train] + ridge, x[train].T @ z[24:300])
    return beta, np.sqrt(np.mean((z[300:380] - x[val] @ beta) ** 2)) * y[:300].std()


def test_candidates_equal_least_squares(spark):
    y = _series()
    found = sea.search(sea.lag_frame(_frame(spark, {"a": y}), SPEC, SPLIT, LAGS), SPEC, MODELS, LAGS).orderBy("candidate").collect()
    assert [r.label for r in found] == ["one", "two", "four", "ridge"] and {(r.n_train, r.n_val) for r in found} == {(276, 80)}
    for r, model in zip(found, MODELS, strict=True):
        beta, error = _expected(y, model)
        at = [0, *(1 + LAGS.index(k) for k in sorted(model.lags))]
        assert r.val_RMSE == pytest.approx(error, rel=1e-9) and np.allclose(np.array(r.beta)[at], beta)
        assert not np.delete(np.array(r.beta), at).any()
    assert [r.chosen for r in found] == [r.val_RMSE == min(x.val_RMSE for x in found) for r in found]


def test_forecasts_use_the_choice_or_the_last_value(spark):
    y = _series()
    short, flat, holes = y[:30], np.full(420, 7.0), [None if t % 5 == 0 else v for t, v in enumerate(y)]
    out = sea.searched_forecasts(_frame(spark, {"a": y, "short": short, "flat": flat, "holes": holes}), SPEC, SPLIT, MODELS).collect()
    got = {(r.cell, r.ts): r.y_pred for r in out}
    assert len(out) == 420 * 3 + 30
    best = min(MODELS, key=lambda m: _expected(y, m)[1])
    beta, _ = _expected(y, best)
    z = (y - y[:300].mean()) / y[:300].std()
    for t in (24, 350, 419):
        want = np.dot(beta, [1.0, *(z[t - k] for k in sorted(best.lags))]) * y[:300].std() + y[:300].mean()
        assert got["a", START + timedelta(hours=t)] == pytest.approx(want)
    assert got["a", START] is None and got["a", START + timedelta(hours=5)] == pytest.approx(y[4])
    assert got["short", START + timedelta(hours=29)] == pytest.approx(y[28])  # too few rows for any candidate
    assert got["flat", START + timedelta(hours=400)] == pytest.approx(7.0)  # a singular system
    assert got["holes", START + timedelta(hours=402)] is not None


def test_the_test_window_does_not_change_the_choice(spark):
    y = _series()
    wild = np.concatenate([y[:380], np.random.default_rng(1).normal(0, 1e6, 40)])
    a, b = ([(r.label, r.val_RMSE, r.chosen) for r in sea.search(sea.lag_frame(_frame(spark, {"a": s}), SPEC, SPLIT, LAGS), SPEC, MODELS, LAGS).orderBy("candidate").collect()] for s in (y, wild))
    assert [x[0::2] for x in a] == [x[0::2] for x in b] and np.allclose([x[1] for x in a], [x[1] for x in b])


def test_no_rows(spark):
    empty = _frame(spark, {"a": _series(10)}).limit(0)
    assert sea.search(sea.lag_frame(empty, SPEC, SPLIT, LAGS), SPEC, MODELS, LAGS).count() == 0
    assert sea.searched_forecasts(empty, SPEC, SPLIT, MODELS).count() == 0
