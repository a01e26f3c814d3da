"""Walk-forward evaluation, metrics, leaderboards and failure windows.

V1-V7, A10-A13, A19, J7, T3, T5, W7. Inputs are long forecast tables
``(model, entity, ts, y_true, y_pred)``.
"""

from __future__ import annotations

from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions.metrics import all_metrics
from .series import ts_literal


def walk_forward(forecasts: DataFrame, spec: SeriesSpec, start: datetime, end: datetime, strict: bool = False) -> DataFrame:
    """Restrict all-row one-step forecasts to the inclusive window (V1).

    With ``strict=True`` an empty window raises ``ValueError`` (one cheap
    ``limit(1)`` job), as the original loop did.
    """
    lo = ts_literal(forecasts, spec.ts, start, spec.tz)
    hi = ts_literal(forecasts, spec.ts, end, spec.tz)
    out = forecasts.where(F.col(spec.ts).between(lo, hi))
    if strict and out.limit(1).count() == 0:
        raise ValueError(f"no row to forecast from {start} to {end}")
    return out


def metrics_table(forecasts: DataFrame, spec: SeriesSpec, epsilon: float = 1e-3, decimals: int | None = None) -> DataFrame:
    """MAE, RMSE, MAPE %, sMAPE % per (entity, model) in one aggregate.

    ``decimals`` rounds half-to-even, like Python's ``round`` (P5).
    """
    out = forecasts.groupBy(spec.entity, "model").agg(*all_metrics(F.col("y_true"), F.col("y_pred"), epsilon))
    if decimals is not None:
        for c in ("MAE", "RMSE", "MAPE_percent", "sMAPE_percent"):
            out = out.withColumn(c, F.bround(c, decimals))
    return out


def leaderboard(metrics: DataFrame, spec: SeriesSpec, by: str = "MAE") -> DataFrame:
    """Models ranked within each entity by ``by`` ascending."""
    w = Window.partitionBy(spec.entity).orderBy(F.col(by).asc_nulls_last(), F.col("model"))
    return metrics.withColumn("rank", F.row_number().over(w))


def residual_table(forecasts: DataFrame, spec: SeriesSpec, models: Sequence[str]) -> DataFrame:
    """Truth and every model's prediction aligned on (entity, ts).

    Alignment is by key, not position; one residual column per model. One
    aggregate on the key gives the truth and every model's prediction.
    """
    picked = [F.max(F.when(F.col("model") == m, F.col("y_pred"))).alias(f"pred_{m}") for m in models]
    out = forecasts.groupBy(spec.entity, spec.ts).agg(F.max("y_true").alias("y_true"), *picked)
    return out.select("*", *[(F.col("y_true") - F.col(f"pred_{m}")).alias(f"resid_{m}") for m in models])


def rolling_mae(forecasts: DataFrame, spec: SeriesSpec, window: int = 6) -> DataFrame:
    """Rolling mean absolute error over the last ``window`` rows; NULL until full."""
    w = Window.partitionBy(spec.entity, "model").orderBy(spec.ts).rowsBetween(-(window - 1), 0)
    ae = F.abs(F.col("y_true") - F.col("y_pred"))
    return forecasts.withColumn(
        "rolling_mae", F.when(F.count(ae).over(w) == window, F.avg(ae).over(w))
    )


def joint_failure(
    forecasts: DataFrame,
    spec: SeriesSpec,
    window: int = 6,
    multiplier: float = 2.0,
    n_models: int | None = None,
) -> DataFrame:
    """Worst step where every model's rolling MAE exceeds ``multiplier`` x its own mean (V5).

    Severity = sum over models of rolling MAE / mean AE at jointly flagged
    steps; the peak is the argmax (earliest on a tie). Output per entity:
    (entity, start, end, ratios map model → ratio at the peak); entities with
    no joint spike have no row. Incomplete windows never flag.
    """
    ae = F.abs(F.col("y_true") - F.col("y_pred"))
    by_model = Window.partitionBy(spec.entity, "model")
    roll = by_model.orderBy(spec.ts).rowsBetween(-(window - 1), 0)
    staged = forecasts.select(
        spec.entity,
        spec.ts,
        "model",
        F.when(F.count(ae).over(roll) == window, F.avg(ae).over(roll)).alias("_r"),
        F.avg(ae).over(by_model).alias("_a"),
    )
    staged = staged.select(
        "*",
        F.coalesce(F.col("_r") > F.col("_a") * multiplier, F.lit(False)).alias("_flag"),
        (F.col("_r") / F.greatest(F.col("_a"), F.lit(1e-9))).alias("_ratio"),
    )
    per_step = staged.groupBy(spec.entity, spec.ts).agg(
        F.bool_and("_flag").alias("_joint"),
        F.count("model").alias("_n"),
        F.sum("_ratio").alias("severity"),
        F.map_from_entries(F.collect_list(F.struct("model", "_ratio"))).alias("ratios"),
    )
    cond = F.col("_joint")
    if n_models is not None:
        cond = cond & (F.col("_n") == n_models)
    pick = Window.partitionBy(spec.entity).orderBy(F.desc("severity"), F.asc(spec.ts))
    best = per_step.where(cond).withColumn("_k", F.row_number().over(pick)).where("_k = 1")
    half = F.make_dt_interval(secs=F.lit((spec.step * window) // 2).cast("decimal(18,6)"))
    return best.select(
        spec.entity,
        (F.col(spec.ts) - half).alias("start"),
        (F.col(spec.ts) + half).alias("end"),
        F.col(spec.ts).alias("peak"),
        "severity",
        "ratios",
    )


def failure_context(
    forecasts: DataFrame,
    failures: DataFrame,
    spec: SeriesSpec,
    margin_seconds: int = 7200,
) -> DataFrame:
    """Rows within ``margin`` of each failure window (V6).

    An equi-join on entity with a range condition on ts; failures hold at
    most one row per entity, so the join streams the forecast side once.
    """
    margin = F.make_dt_interval(secs=F.lit(margin_seconds).cast("decimal(18,6)"))
    f = failures.select(
        F.col(spec.entity).alias("_e"),
        (F.col("start") - margin).alias("_lo"),
        (F.col("end") + margin).alias("_hi"),
        F.col("start").alias("window_start"),
        F.col("end").alias("window_end"),
    )
    cond = (F.col(spec.entity) == F.col("_e")) & F.col(spec.ts).between(F.col("_lo"), F.col("_hi"))
    joined = forecasts.join(f, cond, "inner")
    in_window = F.col(spec.ts).between(F.col("window_start"), F.col("window_end"))
    return joined.select(
        "model", spec.entity, spec.ts, "y_true", "y_pred", in_window.alias("in_window")
    )


def validation_scores(forecasts: DataFrame, spec: SeriesSpec, start: datetime, end: datetime, epsilon: float = 1e-3) -> DataFrame:
    """Walk-forward metrics on the validation window (V7)."""
    return metrics_table(walk_forward(forecasts, spec, start, end), spec, epsilon)
