"""train → forecast → evaluate as Spark jobs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DhrConfig, EvalConfig, SeriesSpec, Split
from ..operators import evaluate as ev
from ..operators import forecast as fc
from ..operators import grouped as gm
from ..operators import harmonic as har
from ..operators import learned
from ..operators import reporting as rep


def train_dhr(series: DataFrame, spec: SeriesSpec, split: Split, out: str, cfg: DhrConfig = DhrConfig()) -> DataFrame:
    """Fit every entity and persist the parameter table (no pickles)."""
    params = gm.dhr_fit(series, spec, split, cfg)
    params.write.mode("overwrite").parquet(out)
    return series.sparkSession.read.parquet(out)


def train(series: DataFrame, spec: SeriesSpec, split: Split, out: str, families: list[str], session_tz: str = "UTC") -> None:
    """Fit and save each family below ``out`` (G11, K10): harmonic and dhr as parameter tables, learned ones as pipelines."""
    for name in families:
        path = os.path.join(out, name)
        if name == "harmonic":
            har.harmonic_fit(series, spec, split).write.mode("overwrite").parquet(path)
        elif name == "dhr":
            train_dhr(series, spec, split, path)
        elif name in ("learned_linear", "learned_tree"):
            learned.train(series, spec, split, path, name.removeprefix("learned_"), session_tz)
        else:
            raise ValueError(f"no family to train is named {name!r}")


def forecast_trained(spark: SparkSession, series: DataFrame, spec: SeriesSpec, models: str, family: str, session_tz: str = "UTC") -> DataFrame:
    """Forecasts of every row from what :func:`train` saved."""
    path = os.path.join(models, family)
    if family == "harmonic":
        return har.harmonic_forecasts(series, spec, params=spark.read.parquet(path))
    if family == "dhr":
        return gm.dhr_forecasts(series, spec, params=spark.read.parquet(path))
    return learned.forecast_saved(series, spec, path, session_tz, family)


def forecast(
    spark: SparkSession,
    series: DataFrame,
    spec: SeriesSpec,
    split: Split,
    models: list[str],
    out: str,
    params: DataFrame | None = None,
) -> DataFrame:
    """Walk-forward forecasts on the test window for the named models, one table."""
    parts = []
    base = {m: p for m, p in {"naive_last": None, "naive_daily": spec.daily, "naive_weekly": spec.weekly}.items() if m in models}
    if base:
        parts.append(fc.baseline_forecasts(series, spec, base))
    if "dhr" in models:
        parts.append(gm.dhr_forecasts(series, spec, split, params=params))
    for m in models:
        if m not in base and m != "dhr":
            parts.append(fc.get_forecaster(m, spec)(series, split=split))
    if not parts:
        raise ValueError("name at least one model")
    f = parts[0]
    for p in parts[1:]:
        f = f.unionByName(p)
    f = ev.walk_forward(f, spec, split.test_start, split.test_end, strict=True)
    rep.write_forecasts(f, out, spec.entity)
    return spark.read.parquet(out)


def evaluate(forecasts: DataFrame, spec: SeriesSpec, out: str, cfg: EvalConfig = EvalConfig()) -> dict[str, DataFrame]:
    """Metrics per (entity, model), leaderboard, comparison lines, joint failures."""
    metrics = ev.metrics_table(forecasts, spec, cfg.mape_epsilon, cfg.metric_decimals)
    board = ev.leaderboard(metrics, spec)
    rep.write_partitioned_csv(board, os.path.join(out, "metrics"), spec.entity)
    lines = rep.markdown_table(board, [spec.entity, "model", "MAE", "RMSE", "MAPE_percent", "sMAPE_percent"], [spec.entity, "rank"])
    rep.write_text(lines, os.path.join(out, "comparison"))
    n_models = forecasts.select("model").distinct().count()
    failures = ev.joint_failure(forecasts, spec, cfg.failure_window, cfg.failure_multiplier, n_models=n_models)
    return {"metrics": metrics, "leaderboard": board, "comparison": lines, "failures": failures}


def train_log(params: DataFrame, entity: str) -> DataFrame:
    """Per-entity training time and steps from a fitted parameter table."""
    return params.select("model", F.col(entity), "train_seconds", F.col("n_train").alias("train_steps"))


def run_log(train_times: DataFrame, predict_times: DataFrame, keys=("model", "square_id")) -> DataFrame:
    """Merge training and forecasting timings per (model, entity)."""
    return rep.upsert(train_times, predict_times, list(keys), merge_columns=True).orderBy(*keys)


__all__ = ["train_dhr", "forecast", "evaluate", "run_log", "F"]
