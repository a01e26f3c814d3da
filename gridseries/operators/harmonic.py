"""Dynamic harmonic regression for every entity at once.

Fourier terms by least squares and an autoregression of order two on the residuals,
both from sums of products: one aggregate per entity for each, a small solve on
the resulting row, and the forecasts as plain columns. No series is gathered
into a task; the only grouped state is one row of sums for each entity.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SeriesSpec, Split
from ..functions import time as tf
from .features import fourier_columns
from .series import split_label

#: Training rows needed for each regressor; below, an entity is forecast by its last value.
ROWS_PER_TERM = 4
#: A forecast may leave the range of the (transformed) training values by this share of its width.
RANGE_MARGIN = 0.25


def _design(rows: DataFrame, spec: SeriesSpec, daily_terms: int, weekly_terms: int) -> list[Column]:
    """Intercept, then daily and weekly Fourier pairs counted from the anchor."""
    step = tf.step_index(rows, spec.ts, spec.step, F.col("anchor")).cast("double")
    return [F.lit(1.0), *fourier_columns(step, spec.daily, daily_terms), *fourier_columns(step, spec.weekly, weekly_terms)]


def n_terms(daily_terms: int, weekly_terms: int) -> int:
    return 1 + 2 * daily_terms + 2 * weekly_terms


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve(products: pd.Series) -> pd.Series:
    """Coefficients from the upper triangle of X'X followed by X'y; null if the system has no unique solution."""
    out = []
    for flat in products:
        k = int((np.sqrt(9 + 8 * len(flat)) - 3) / 2)  # k (k + 1) / 2 + k values
        a = np.zeros((k, k))
        a[np.triu_indices(k)] = flat[: k * (k + 1) // 2]
        a = a + np.triu(a, 1).T
        ok = np.isfinite(a).all() and np.linalg.cond(a) < 1e10
        out.append(np.linalg.solve(a, flat[k * (k + 1) // 2 :]) if ok else None)
    return pd.Series(out)


def _value(rows: DataFrame, spec: SeriesSpec) -> Column:
    """The value on the scale of the fit: log1p where the training minimum is not negative."""
    v = F.col(spec.value).cast("double")
    return F.when(F.col("use_log"), F.when(v >= 0, F.log1p(v))).otherwise(v)


def harmonic_fit(
    series: DataFrame, spec: SeriesSpec, split: Split, daily_terms: int = 4, weekly_terms: int = 3, use_log1p: bool = True
) -> DataFrame:
    """Parameters from the training rows, one row per entity that has any.

    (entity, anchor, use_log, n_train, low, high, beta, phi1, phi2, sigma2). ``beta``
    is null for an entity with fewer than four training rows a term or a
    singular system. An autoregression that is not stationary is set to zero.
    """
    e = spec.entity
    v = F.col(spec.value).cast("double")
    train = series.where((split_label(series, spec, split) == "train") & v.isNotNull()).select(e, spec.ts, spec.value)
    shape = train.groupBy(e).agg(
        F.min(tf.epoch_seconds(train, spec.ts)).alias("anchor"),
        ((F.min(v) >= 0) & F.lit(use_log1p)).alias("use_log"),
        F.count(F.lit(1)).alias("n_train"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
    )
    for c in ("low", "high"):
        shape = shape.withColumn(c, F.when(F.col("use_log"), F.log1p(c)).otherwise(F.col(c)))
    rows = train.join(shape, e)
    x, y = _design(rows, spec, daily_terms, weekly_terms), _value(rows, spec)
    k = len(x)
    rows = rows.select(e, spec.ts, y.alias("_y"), F.array(*x).alias("_x"))
    pick = [F.col("_x")[i] for i in range(k)]
    sums = [F.sum(pick[i] * pick[j]) for i in range(k) for j in range(i, k)] + [F.sum(p * F.col("_y")) for p in pick]
    products = rows.groupBy(e).agg(F.count(F.lit(1)).alias("_n"), F.array(*sums).alias("_s"))
    beta = products.select(e, F.when(F.col("_n") >= ROWS_PER_TERM * k, _solve("_s")).alias("beta"))

    fitted = rows.join(beta, e)
    dot = F.aggregate(F.zip_with("_x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
    w = Window.partitionBy(e).orderBy(spec.ts)
    r = fitted.select(e, spec.ts, (F.col("_y") - dot).alias("r"))
    r = r.select(e, "r", F.lag("r", 1).over(w).alias("a"), F.lag("r", 2).over(w).alias("b"))
    full = F.col("b").isNotNull()
    ar = r.groupBy(e).agg(*[F.sum(F.when(full, F.col(p) * F.col(q))).alias(p + q) for p, q in ("aa", "ab", "bb", "ra", "rb", "rr")])
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    solvable = det > 1e-9 * F.col("aa") * F.col("bb")
    phi1 = F.when(solvable, (F.col("ra") * F.col("bb") - F.col("rb") * F.col("ab")) / det)
    phi2 = F.when(solvable, (F.col("rb") * F.col("aa") - F.col("ra") * F.col("ab")) / det)
    ar = ar.select(e, "rr", "ra", "rb", phi1.alias("p1"), phi2.alias("p2"))
    stable = (F.abs("p2") < 1) & (F.col("p1") + F.col("p2") < 1) & (F.col("p2") - F.col("p1") < 1)
    ar = ar.select(e, "rr", "ra", "rb", *[F.coalesce(F.when(stable, F.col(p)), F.lit(0.0)).alias(q) for p, q in (("p1", "phi1"), ("p2", "phi2"))])
    # sum of squared errors of the autoregression over its rows
    sse = F.col("rr") - F.col("phi1") * F.col("ra") - F.col("phi2") * F.col("rb")
    out = shape.join(beta, e, "left").join(ar, e, "left")
    return out.select(
        e, "anchor", "use_log", "n_train", "low", "high", "beta",
        F.when(F.col("beta").isNotNull(), F.col("phi1")).alias("phi1"),
        F.when(F.col("beta").isNotNull(), F.col("phi2")).alias("phi2"),
        F.when(F.col("beta").isNotNull(), F.greatest(F.lit(0.0), sse) / F.greatest(F.col("n_train") - 2, F.lit(1))).alias("sigma2"),
    )


def harmonic_forecasts(
    series: DataFrame,
    spec: SeriesSpec,
    split: Split | None = None,
    daily_terms: int = 4,
    weekly_terms: int = 3,
    params: DataFrame | None = None,
    name: str = "harmonic",
) -> DataFrame:
    """One-step forecasts of every row: (model, entity, ts, y_true, y_pred).

    The regression at the row plus the autoregression on the two residuals
    before it, kept within a margin of the training range. An entity without coefficients, also one that
    has no training row at all, gets its last value, so no entity is lost.
    """
    if params is None:
        if split is None:
            raise ValueError("give a split to fit, or fitted params")
        params = harmonic_fit(series, spec, split, daily_terms, weekly_terms)
    e = spec.entity
    rows = series.select(e, spec.ts, spec.value).join(params, e, "left")
    x = _design(rows, spec, daily_terms, weekly_terms)
    line = sum((F.col("beta")[i] * c for i, c in enumerate(x)), F.lit(0.0))
    rows = rows.withColumn("_fit", line).withColumn("_y", _value(rows, spec)).withColumn("_t", tf.epoch_seconds(rows, spec.ts))
    rows = rows.withColumn("_r", F.col("_y") - F.col("_fit"))
    w = Window.partitionBy(e).orderBy("_t")
    ar = F.coalesce(F.col("phi1") * F.lag("_r", 1).over(w), F.lit(0.0)) + F.coalesce(F.col("phi2") * F.lag("_r", 2).over(w), F.lit(0.0))
    margin = (F.col("high") - F.col("low")) * RANGE_MARGIN
    pred = F.greatest(F.col("low") - margin, F.least(F.col("high") + margin, F.col("_fit") + ar))
    pred = F.when(F.col("use_log"), F.expm1(pred)).otherwise(pred)
    rows = rows.withColumn("_p", F.when(F.col("beta").isNotNull(), pred)).withColumn("_last", F.last(F.col(spec.value)).over(w.rangeBetween(Window.unboundedPreceding, -spec.step)))
    return rows.select(F.lit(name).alias("model"), e, spec.ts, F.col(spec.value).alias("y_true"), F.coalesce("_p", "_last").cast("double").alias("y_pred"))
