"""Grouped-map operators: numpy kernels run per entity on executors.

E3 E4 E5 E6 E7 E9 E10 E12 G7. Each is ``groupBy(entity).applyInPandas``
(or ``cogroup`` with a parameter table), so every series is processed in
parallel, one group per entity. A group is one binned series (at most
span / step rows, ~9k for the telecom grid), never raw rows, so it fits in
one task whatever the raw volume. Results are joined back by entity.
"""

from __future__ import annotations

import logging
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DhrConfig, SeriesSpec, Split
from ..functions import time as tf
from ..kernels import arma, stl
from .series import interpolate, split_label

log = logging.getLogger(__name__)


def _etype(df: DataFrame, spec: SeriesSpec) -> str:
    return df.schema[spec.entity].dataType.simpleString()


def _tstype(df: DataFrame, spec: SeriesSpec) -> str:
    return df.schema[spec.ts].dataType.simpleString()


def _ordered(pdf: pd.DataFrame, spec: SeriesSpec) -> pd.DataFrame:
    return pdf.sort_values(spec.ts, kind="mergesort").reset_index(drop=True)


def _values(pdf: pd.DataFrame, spec: SeriesSpec) -> np.ndarray:
    return pdf[spec.value].to_numpy(dtype=float, na_value=np.nan)


# ---------------------------------------------------------------- STL
def stl_decompose(series: DataFrame, spec: SeriesSpec, period: int, robust: bool = True, fill: bool = True) -> DataFrame:
    """Robust STL per entity after positional interpolation.

    Output matches :func:`classical_decompose`: (entity, ts, period,
    observed, trend, seasonal, resid). A series the method cannot handle
    (shorter than two periods) is logged and yields no rows.
    """
    ent = spec.entity
    s = interpolate(series, spec) if fill else series

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _ordered(pdf, spec)
        y = _values(pdf, spec)
        try:
            seas, trend, resid = stl.stl(y, period, robust=robust)
        except ValueError as exc:
            log.warning("STL failed for %s period %d: %s", pdf[ent].iloc[0], period, exc)
            return pd.DataFrame(columns=[ent, spec.ts, "period", "observed", "trend", "seasonal", "resid"])
        return pd.DataFrame(
            {
                ent: pdf[ent],
                spec.ts: pdf[spec.ts],
                "period": period,
                "observed": y,
                "trend": trend,
                "seasonal": seas,
                "resid": resid,
            }
        )

    schema = (
        f"{ent} {_etype(series, spec)}, {spec.ts} {_tstype(series, spec)}, period int, "
        "observed double, trend double, seasonal double, resid double"
    )
    return s.select(ent, spec.ts, spec.value).groupBy(ent).applyInPandas(fn, schema)


def stl_outliers(series: DataFrame, spec: SeriesSpec, period: int, z_threshold: float = 4.0) -> DataFrame:
    """STL remainder z-score screen."""
    from .anomalies import residual_outliers

    return residual_outliers(stl_decompose(series, spec, period), spec, z_threshold)


# ---------------------------------------------------------------- DHR
def _dhr_design(pdf: pd.DataFrame, spec: SeriesSpec, anchor: int, cfg: DhrConfig) -> np.ndarray:
    steps = np.floor((pdf["_t"].to_numpy(dtype=float) - anchor) / spec.step)
    return arma.fourier_matrix(steps, [(spec.daily, cfg.daily_terms), (spec.weekly, cfg.weekly_terms)])


PARAMS_SCHEMA_TAIL = (
    "model string, anchor bigint, use_log boolean, intercept boolean, p int, d int, q int, daily_terms int, weekly_terms int, "
    "beta array<double>, phi array<double>, theta array<double>, sigma2 double, n_train bigint, train_seconds double"
)


def dhr_fit(series: DataFrame, spec: SeriesSpec, split: Split, cfg: DhrConfig = DhrConfig()) -> DataFrame:
    """Fit Fourier + ARMA per entity on its training rows.

    Returns a parameter table (one row per entity) that can be written to
    Parquet and reused; log1p is applied when enabled and the training
    minimum is >= 0. The anchor of the Fourier terms is the first training ts.
    """
    ent = spec.entity
    train = series.where(split_label(series, spec, split) == "train")
    train = train.select(ent, spec.value, tf.epoch_seconds(train, spec.ts).alias("_t"))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t", kind="mergesort").reset_index(drop=True)
        y = _values(pdf, spec)
        use_log = bool(cfg.use_log1p and np.nanmin(y) >= 0)
        yt = np.log1p(y) if use_log else y
        anchor = int(pdf["_t"].iloc[0])
        x = _dhr_design(pdf, spec, anchor, cfg)
        t0 = time.perf_counter()
        par = arma.fit_regression_arma(yt, x, cfg.p, cfg.q, cfg.intercept, cfg.css_iterations, cfg.d)
        secs = time.perf_counter() - t0
        return pd.DataFrame(
            {
                ent: [pdf[ent].iloc[0]],
                "model": ["dhr"],
                "anchor": [anchor],
                "use_log": [use_log],
                "intercept": [cfg.intercept],
                "p": [cfg.p],
                "d": [cfg.d],
                "q": [cfg.q],
                "daily_terms": [cfg.daily_terms],
                "weekly_terms": [cfg.weekly_terms],
                "beta": [par["beta"].tolist()],
                "phi": [par["phi"].tolist()],
                "theta": [par["theta"].tolist()],
                "sigma2": [par["sigma2"]],
                "n_train": [len(pdf)],
                "train_seconds": [secs],
            }
        )

    return train.groupBy(ent).applyInPandas(fn, f"{ent} {_etype(series, spec)}, {PARAMS_SCHEMA_TAIL}")


def dhr_forecasts(
    series: DataFrame,
    spec: SeriesSpec,
    split: Split | None = None,
    cfg: DhrConfig = DhrConfig(),
    params: DataFrame | None = None,
) -> DataFrame:
    """One-step forecasts of every row from fitted parameters.

    Series and parameters are co-grouped by entity; each group runs one
    linear recursion over its whole ordered series, so validation rows feed
    the state before the test window without refitting.
    Output: (model, entity, ts, y_true, y_pred).
    """
    if params is None:
        if split is None:
            raise ValueError("give a split to fit, or fitted params")
        params = dhr_fit(series, spec, split, cfg)
    ent = spec.entity
    rows = series.select(ent, spec.ts, spec.value, tf.epoch_seconds(series, spec.ts).alias("_t"))

    def fn(pdf: pd.DataFrame, prm: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or prm.empty:
            return pd.DataFrame(columns=["model", ent, spec.ts, "y_true", "y_pred"])
        pdf = pdf.sort_values("_t", kind="mergesort").reset_index(drop=True)
        par = prm.iloc[0]
        y = _values(pdf, spec)
        use_log = bool(par["use_log"])
        yt = np.log1p(np.where(y >= 0, y, np.nan)) if use_log else y
        # the parameter row carries the design it was fitted with
        terms = DhrConfig(daily_terms=int(par["daily_terms"]), weekly_terms=int(par["weekly_terms"]))
        x = _dhr_design(pdf, spec, int(par["anchor"]), terms)
        pred = arma.one_step_forecasts(
            yt,
            x,
            {
                "beta": list(par["beta"]),
                "phi": list(par["phi"]),
                "theta": list(par["theta"]),
                "intercept": bool(par["intercept"]),
                "d": int(par["d"]),
            },
        )
        yhat = np.expm1(pred) if use_log else pred
        return pd.DataFrame({"model": par["model"], ent: pdf[ent], spec.ts: pdf[spec.ts], "y_true": y, "y_pred": yhat})

    schema = f"model string, {ent} {_etype(series, spec)}, {spec.ts} {_tstype(series, spec)}, y_true double, y_pred double"
    return rows.groupBy(ent).cogroup(params.groupBy(ent)).applyInPandas(fn, schema)
