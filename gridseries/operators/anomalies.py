"""Anomaly screens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions.stats import guarded_div
from .series import interpolate
from .windows import flag_column, runs


def residual_outliers(decomp: DataFrame, spec: SeriesSpec, z_threshold: float = 4.0) -> DataFrame:
    """Rows whose remainder z-score exceeds the threshold.

    z = (r - mean r) / max(pop std r, 1e-12) per (entity, period); works on
    the output of either decomposition. Output:
    (entity, ts, value, residual, z).
    """
    w = Window.partitionBy(spec.entity, "period")
    r = F.col("resid")
    z = (r - F.avg(r).over(w)) / F.greatest(F.stddev_pop(r).over(w), F.lit(1e-12))
    return (
        decomp.select(spec.entity, spec.ts, F.col("observed").alias("value"), r.alias("residual"), z.alias("z"))
        .where(F.abs(F.col("z")) > z_threshold)
    )


def drop_runs(
    series: DataFrame,
    spec: SeriesSpec,
    period: int | None = None,
    threshold: float = 0.6,
    min_run: int = 6,
) -> DataFrame:
    """Sustained drops against the value one season earlier.

    After positional interpolation, base = value ``period`` rows earlier,
    rel = (v - base) / base (NULL where abs(base) < 1e-6, so a zero baseline
    never flags); rows with rel < -threshold form runs, and runs of at least
    ``min_run`` rows are reported as (entity, start, end, mean_relative_drop).
    """
    period = spec.weekly if period is None else period
    s = interpolate(series, spec)
    w = Window.partitionBy(spec.entity).orderBy(spec.ts)
    base = F.lag(spec.value, period).over(w)
    rel = guarded_div(F.col(spec.value) - base, base)
    staged = s.withColumn("relative_drop", rel).withColumn("_flag", flag_column(F.col("relative_drop") < -threshold))
    out = runs(staged, spec, "_flag", min_run, measure="relative_drop")
    return out.select(spec.entity, "start", "end", F.col("mean_relative_drop"), "length")
