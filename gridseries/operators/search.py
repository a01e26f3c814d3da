"""Search over linear lag models from shared sums of products.

Every candidate is a set of lags with a ridge penalty. The frame with the widest lag set is
read once: one aggregate sums the products of all its columns for the training rows and for the
validation rows of each entity. Any candidate's coefficients follow from its part of the first
matrix, its squared validation error from the second, so a further candidate
costs a small solve on one row of sums and no further pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec, Split
from .features import fit_scaler, lag_features, scaled
from .harmonic import ROWS_PER_TERM
from .series import split_label
from .util import staged

#: A system of worse condition counts as singular, and its candidate as not fitted.
WORST_CONDITION = 1e10


@dataclass(frozen=True)
class LagModel:
    """A candidate: intercept and these positional lags, with a penalty for each training row."""

    label: str
    lags: tuple[int, ...]
    penalty: float = 0.0


def lag_frame(series: DataFrame, spec: SeriesSpec, split: Split, lags: list[int]) -> DataFrame:
    """Scaled value ``z``, ``x`` (1 and the lags of z; NULL where one is missing), last value and split of every row."""
    z = scaled(series.select(spec.entity, spec.ts, spec.value), spec, fit_scaler(series, spec, split))
    z = lag_features(z, spec, lags, col="z", complete=False)
    last = F.lag(spec.value, 1).over(Window.partitionBy(spec.entity).orderBy(spec.ts))
    columns = [F.col(f"lag_{k}") for k in lags]
    full = F.lit(True)
    for c in columns:
        full = full & c.isNotNull()
    x = F.when(full, F.array(F.lit(1.0), *columns))
    out = z.select(spec.entity, spec.ts, spec.value, "scale_mean", "scale_std", "z", x.alias("x"), last.alias("last"), split_label(z, spec, split).alias("split"))
    return staged(out, "lag-frame")  # read for the sums and for the forecasts


def _candidate_scores(models: list[LagModel], lags: list[int]):
    """A vectorised function from sums of products to, for each candidate, its mean squared validation error and coefficients."""
    k = len(lags) + 1
    places = [[0, *(1 + lags.index(lag) for lag in sorted(m.lags))] for m in models]

    def matrix(flat: np.ndarray) -> np.ndarray:
        a = np.zeros((k + 1, k + 1))
        a[np.triu_indices(k + 1)] = flat
        return a + np.triu(a, 1).T

    def solved(train: np.ndarray, val: np.ndarray, n_train: int, n_val: int) -> list[list[float]]:
        a, b, out = matrix(train), matrix(val), []
        for model, at in zip(models, places, strict=True):
            ridge = np.diag([0.0, *[model.penalty * n_train] * (len(at) - 1)])
            system = a[np.ix_(at, at)] + ridge
            if n_train < ROWS_PER_TERM * len(at) or not np.isfinite(system).all() or np.linalg.cond(system) > WORST_CONDITION:
                out.append([])
                continue
            residual = np.zeros(k + 1)
            residual[at], residual[k] = np.linalg.solve(system, a[at, k]), -1.0
            error = max(0.0, float(residual @ b @ residual)) / n_val if n_val else float("nan")
            out.append([error, *residual[:k].tolist()])
        return out

    @F.pandas_udf("array<array<double>>")
    def scores(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([solved(*row) for row in zip(*batch, strict=True)], dtype=object)

    return scores


def search(frame: DataFrame, spec: SeriesSpec, models: list[LagModel], lags: list[int]) -> DataFrame:
    """(entity, label, candidate, n_train, n_val, val_RMSE, beta, chosen), a row for each entity and candidate.

    All candidates of an entity are fitted and judged on the same rows, those with every
    lag. ``chosen`` marks the least error on validation, the first such candidate on a
    tie. A candidate with fewer than four training rows a term, or a singular system, has NULL error; an
    entity without validation rows has no chosen one, an entity without full rows no row.
    """
    e = spec.entity
    rows = frame.where(F.col("x").isNotNull() & F.col("z").isNotNull() & F.col("split").isin("train", "validation"))
    v = [*[F.col("x")[i] for i in range(len(lags) + 1)], F.col("z")]

    def products(split: str):
        return F.array(*[F.coalesce(F.sum(F.when(F.col("split") == split, v[i] * v[j])), F.lit(0.0)) for i in range(len(v)) for j in range(i, len(v))])

    sums = rows.groupBy(e).agg(
        products("train").alias("train"),
        products("validation").alias("val"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "validation").alias("n_val"),
        F.max("scale_std").alias("scale_std"),
    )
    scored = sums.withColumn("scores", _candidate_scores(models, lags)("train", "val", "n_train", "n_val"))
    scored = staged(scored.drop("train", "val"), "candidates")  # the solves run once, whatever reads the result
    each = scored.select(e, "n_train", "n_val", "scale_std", F.posexplode("scores").alias("candidate", "score"))
    error = F.nanvl(F.try_element_at("score", F.lit(1)), F.lit(None).cast("double"))
    beta = F.when(F.size("score") > 0, F.slice("score", 2, len(lags) + 1))
    labels = F.array(*[F.lit(m.label) for m in models])
    out = each.select(e, labels[F.col("candidate")].alias("label"), "candidate", "n_train", "n_val", (F.sqrt(error) * F.col("scale_std")).alias("val_RMSE"), beta.alias("beta"))
    best = F.row_number().over(Window.partitionBy(e).orderBy(F.col("val_RMSE").asc_nulls_last(), "candidate"))
    return out.withColumn("chosen", (best == 1) & F.col("val_RMSE").isNotNull())


def searched_forecasts(series: DataFrame, spec: SeriesSpec, split: Split, models: list[LagModel], name: str = "lag_search") -> DataFrame:
    """One-step forecasts of every row by each entity's chosen candidate; the last value without one or without every lag."""
    lags = sorted({lag for m in models for lag in m.lags})
    frame = lag_frame(series, spec, split, lags)
    chosen = search(frame, spec, models, lags).where("chosen").select(spec.entity, "beta")
    dot = F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
    return frame.join(chosen, spec.entity, "left").select(
        F.lit(name).alias("model"),
        spec.entity,
        spec.ts,
        F.col(spec.value).alias("y_true"),
        F.coalesce(dot * F.col("scale_std") + F.col("scale_mean"), F.col("last")).alias("y_pred"),
    )
