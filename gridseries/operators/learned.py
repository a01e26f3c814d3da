"""Learned one-step forecasters on lag features with Spark ML.

The original trained one small neural network per cell. Here one model is
trained across all entities at once on scaled lag features plus calendar
features: a Huber linear regression for the sequence slot, gradient-boosted
trees on dilated lags (1, 2, 4, ... steps back) for the convolutional slot.
Scaling is fitted on training rows only; lags come from strictly earlier
rows, so no prediction sees its own target. Rows without a full lag history
fall back to the last value.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec, Split
from .features import calendar_features, fit_scaler, lag_features, scaled
from .series import split_label
from .util import staged

CALENDAR = ["tod_sin", "tod_cos", "dow_sin", "dow_cos", "is_weekend"]


def linear_lags(spec: SeriesSpec, recent: int = 6) -> list[int]:
    return sorted(set(list(range(1, recent + 1)) + [spec.daily, spec.weekly]))


def dilated_lags(spec: SeriesSpec, max_dilation: int = 128) -> list[int]:
    lags, d = [], 1
    while d <= max_dilation:
        lags.append(d)
        d *= 2
    return sorted(set(lags + [spec.daily, spec.weekly]))


def _frame(series: DataFrame, spec: SeriesSpec, split: Split | None, lags: list[int], session_tz: str, scaler: DataFrame | None = None) -> DataFrame:
    """Scaled value, its lags over the whole ordered series, calendar, split label.

    An entity that the scaler does not know stays: its lags are NULL, so it
    gets its last value.
    """
    sc = fit_scaler(series, spec, split) if scaler is None else scaler
    z = scaled(series.select(spec.entity, spec.ts, spec.value), spec, sc)
    z = calendar_features(z, spec, session_tz)
    z = lag_features(z, spec, lags, col="z", complete=False)
    # binned series have one row per (entity, bin), so the previous row is the
    # last value at or before t - step; same window spec as the lags: one sort
    w = Window.partitionBy(spec.entity).orderBy(spec.ts)
    z = z.withColumn("_last", F.lag(spec.value, 1).over(w))
    full = F.lit(True)
    for k in lags:
        full = full & F.col(f"lag_{k}").isNotNull()
    out = z.withColumn("_full", full)
    out = out.withColumn("split", F.lit(None).cast("string") if split is None else split_label(z, spec, split))
    # read by every optimiser pass and again for scoring: computed once
    return staged(out, "learned-frame")


def _predict(model: PipelineModel, frame: DataFrame, spec: SeriesSpec, name: str) -> DataFrame:
    scored = model.transform(frame.where("_full"))
    scored = scored.select(
        spec.entity, spec.ts, F.col(spec.value).alias("y_true"),
        (F.col("prediction") * F.col("scale_std") + F.col("scale_mean")).alias("y_pred"),
    )
    rest = frame.where(~F.col("_full")).select(spec.entity, spec.ts, F.col(spec.value).alias("y_true"), F.col("_last").alias("y_pred"))
    return scored.unionByName(rest).select(F.lit(name).alias("model"), spec.entity, spec.ts, "y_true", "y_pred")


def linear_forecasts(
    series: DataFrame,
    spec: SeriesSpec,
    split: Split,
    session_tz: str = "UTC",
    recent: int = 6,
    epsilon: float = 1.35,
    reg_param: float = 1e-4,
    return_model: bool = False,
):
    """Huber linear regression of z_t on z lags and calendar features."""
    lags = linear_lags(spec, recent)
    frame = _frame(series, spec, split, lags, session_tz)
    feats = [f"lag_{k}" for k in lags] + CALENDAR
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=feats, outputCol="features"),
            LinearRegression(featuresCol="features", labelCol="z", loss="huber", epsilon=epsilon, regParam=reg_param, maxIter=100),
        ]
    )
    train = frame.where((F.col("split") == "train") & F.col("_full") & F.col("z").isNotNull())
    model = pipe.fit(train)
    out = _predict(model, frame, spec, "learned_linear")
    return (out, model) if return_model else out


def tree_forecasts(
    series: DataFrame,
    spec: SeriesSpec,
    split: Split,
    session_tz: str = "UTC",
    max_dilation: int = 128,
    max_iter: int = 60,
    max_depth: int = 5,
    seed: int = 20251201,
    return_model: bool = False,
):
    """Gradient-boosted trees on dilated lags (G9); the validation split stops boosting early."""
    lags = dilated_lags(spec, max_dilation)
    frame = _frame(series, spec, split, lags, session_tz)
    feats = [f"lag_{k}" for k in lags] + CALENDAR
    gbt = GBTRegressor(
        featuresCol="features",
        labelCol="z",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=0.1,
        seed=seed,
        validationIndicatorCol="is_val",
        validationTol=0.001,
    )
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"), gbt])
    fit_rows = frame.where(F.col("split").isin("train", "validation") & F.col("_full") & F.col("z").isNotNull())
    model = pipe.fit(fit_rows.withColumn("is_val", F.col("split") == "validation"))
    out = _predict(model, frame, spec, "learned_tree")
    return (out, model) if return_model else out


def train(series: DataFrame, spec: SeriesSpec, split: Split, path: str, kind: str = "linear", session_tz: str = "UTC", **kw) -> None:
    """Fit one learned family and save it: the pipeline under ``model``, the scaler under ``scaler``."""
    fit = {"linear": linear_forecasts, "tree": tree_forecasts}[kind]
    _, model = fit(series, spec, split, session_tz, return_model=True, **kw)
    model.write().overwrite().save(f"{path}/model")
    fit_scaler(series, spec, split).write.mode("overwrite").parquet(f"{path}/scaler")


def forecast_saved(series: DataFrame, spec: SeriesSpec, path: str, session_tz: str = "UTC", name: str = "learned_linear") -> DataFrame:
    """Forecasts of every row from a saved model; nothing is fitted.

    The lags are those that the saved pipeline reads. Entities that were not in
    the training data get their last value.
    """
    model = PipelineModel.load(f"{path}/model")
    inputs = model.stages[0].getInputCols()
    lags = [int(c.removeprefix("lag_")) for c in inputs if c.startswith("lag_")]
    scaler = series.sparkSession.read.parquet(f"{path}/scaler")
    return _predict(model, _frame(series, spec, None, lags, session_tz, scaler), spec, name)
