"""Hyper-parameter trials scored on the validation window.

All trials of a family run in one Spark job: the series is replicated per
trial with ``explode`` over the (small, driver-given) trial list and each
(trial, entity) group fits and scores independently. The test window is
never touched.
"""

from __future__ import annotations

import time
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DhrConfig, SeriesSpec, Split
from ..functions import time as tf
from ..kernels import arma
from . import evaluate as ev
from . import forecast as fc
from .series import split_label

RESULT_TAIL = (
    "model string, label string, params map<string,string>, train_seconds double, "
    "val_MAE double, val_RMSE double, val_MAPE_percent double, val_sMAPE_percent double, notes string"
)


def naive_trials(series: DataFrame, spec: SeriesSpec, split: Split, periods: dict[str, int | None], epsilon: float = 1e-3) -> DataFrame:
    """Seasonal-naive candidates (label → period, None = last value) on validation.

    Pure Catalyst: one window pass computes every candidate.
    """
    f = fc.baseline_forecasts(series, spec, periods)
    m = ev.metrics_table(ev.walk_forward(f, spec, split.val_start, split.val_end), spec, epsilon)
    label_map = F.create_map(*[x for k, v in periods.items() for x in (F.lit(k), F.lit("last" if v is None else str(v)))])
    return m.select(
        F.lit("naive").alias("model"),
        spec.entity,
        F.col("model").alias("label"),
        F.create_map(F.lit("period"), label_map[F.col("model")]).alias("params"),
        F.lit(0.0).alias("train_seconds"),
        F.col("MAE").alias("val_MAE"),
        F.col("RMSE").alias("val_RMSE"),
        F.col("MAPE_percent").alias("val_MAPE_percent"),
        F.col("sMAPE_percent").alias("val_sMAPE_percent"),
        F.lit("").alias("notes"),
    )


def dhr_trials(series: DataFrame, spec: SeriesSpec, split: Split, trials: Sequence[tuple[str, DhrConfig]], epsilon: float = 1e-3) -> DataFrame:
    """Fourier + ARMA trials: fit on train, one-step forecasts on validation (V8).

    Rows through the end of validation feed the recursion, so validation
    targets have their history; metrics follow A10-A12.
    """
    ent = spec.entity
    labels = [t[0] for t in trials]
    cfgs = {t[0]: t[1] for t in trials}
    rows = series.select(
        ent, spec.value, tf.epoch_seconds(series, spec.ts).alias("_t"), split_label(series, spec, split).alias("_split")
    ).where(F.col("_split").isin("train", "validation"))
    rows = rows.withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t", kind="mergesort").reset_index(drop=True)
        label = pdf["label"].iloc[0]
        cfg = cfgs[label]
        y = pdf[spec.value].to_numpy(dtype=float)
        tr = (pdf["_split"] == "train").to_numpy()
        t0 = time.perf_counter()
        use_log = bool(cfg.use_log1p and np.nanmin(y[tr]) >= 0)
        yt = np.log1p(np.where(y >= 0, y, np.nan)) if use_log else y
        anchor = float(pdf["_t"][tr].iloc[0])
        steps = np.floor((pdf["_t"].to_numpy(dtype=float) - anchor) / spec.step)
        x = arma.fourier_matrix(steps, [(spec.daily, cfg.daily_terms), (spec.weekly, cfg.weekly_terms)])
        par = arma.fit_regression_arma(yt[tr], x[tr], cfg.p, cfg.q, cfg.intercept, cfg.css_iterations, cfg.d)
        secs = time.perf_counter() - t0
        pred = arma.one_step_forecasts(yt, x, par)
        yhat = np.expm1(pred) if use_log else pred
        v = ~tr
        yv, pv = y[v], yhat[v]
        e = yv - pv
        den = (np.abs(yv) + np.abs(pv)) / 2
        smape = np.abs(e)[den > 0] / den[den > 0]
        params = {"p": str(cfg.p), "d": str(cfg.d), "q": str(cfg.q), "daily_terms": str(cfg.daily_terms), "weekly_terms": str(cfg.weekly_terms)}
        return pd.DataFrame(
            {
                ent: [pdf[ent].iloc[0]],
                "model": ["dhr"],
                "label": [label],
                "params": [params],
                "train_seconds": [secs],
                "val_MAE": [float(np.mean(np.abs(e))) if e.size else np.nan],
                "val_RMSE": [float(np.sqrt(np.mean(e * e))) if e.size else np.nan],
                "val_MAPE_percent": [float(np.mean(np.abs(e) / np.maximum(np.abs(yv), epsilon)) * 100) if e.size else np.nan],
                "val_sMAPE_percent": [float(np.mean(smape) * 100) if smape.size else np.nan],
                "notes": [""],
            }
        )

    schema = f"{ent} {series.schema[ent].dataType.simpleString()}, {RESULT_TAIL}"
    out = rows.groupBy(ent, "label").applyInPandas(fn, schema)
    return out.select("model", ent, *[c for c in out.columns if c not in ("model", ent)])


def as_rows(results: DataFrame, param_keys: Sequence[str], decimals: int = 4) -> DataFrame:
    """Flatten ``params`` into ``param.<key>`` columns and round like the report (V9).

    Rounding is half-to-even (Python's ``round``): 3 decimals for seconds,
    ``decimals`` for metrics.
    """
    cols = [c for c in results.columns if c != "params"]
    out = results.select(*cols, *[F.col("params")[k].alias(f"param.{k}") for k in param_keys])
    out = out.withColumn("train_seconds", F.bround("train_seconds", 3))
    for c in ("val_MAE", "val_RMSE", "val_MAPE_percent", "val_sMAPE_percent"):
        out = out.withColumn(c, F.bround(c, decimals))
    return out


def learned_trials(
    series: DataFrame,
    spec: SeriesSpec,
    split: Split,
    grid: Sequence[tuple[str, dict]],
    kind: str = "linear",
    session_tz: str = "UTC",
    epsilon: float = 1e-3,
) -> DataFrame:
    """Spark ML candidates fitted on the training window, scored per entity on
    the validation window (V8 for the learned slots).

    ``grid`` is (label, keyword arguments of the forecaster). Each candidate
    is one distributed fit over all entities; time-ordered validation (not a
    random split) keeps the test window untouched.
    """
    from . import learned

    fn = learned.linear_forecasts if kind == "linear" else learned.tree_forecasts
    parts = []
    for label, kw in grid:
        t0 = time.perf_counter()
        f = fn(series, spec, split, session_tz, **kw)
        m = ev.metrics_table(ev.walk_forward(f, spec, split.val_start, split.val_end), spec, epsilon)
        secs = time.perf_counter() - t0
        params = F.create_map(*[x for k, v in kw.items() for x in (F.lit(k), F.lit(str(v)))])
        parts.append(
            m.select(
                F.lit(f"learned_{kind}").alias("model"),
                spec.entity,
                F.lit(label).alias("label"),
                params.alias("params"),
                F.lit(secs).alias("train_seconds"),
                F.col("MAE").alias("val_MAE"),
                F.col("RMSE").alias("val_RMSE"),
                F.col("MAPE_percent").alias("val_MAPE_percent"),
                F.col("sMAPE_percent").alias("val_sMAPE_percent"),
                F.lit("").alias("notes"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def best_trials(results: DataFrame, spec: SeriesSpec, by: str = "val_MAE") -> DataFrame:
    """The best label per (model, entity) on the validation metric."""
    from pyspark.sql import Window

    w = Window.partitionBy("model", spec.entity).orderBy(F.col(by).asc_nulls_last(), F.col("label"))
    return results.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
