"""Classical additive decomposition and strength scores (E7 SQL variant, E8, A15).

The robust LOESS (STL) decomposition runs as a grouped numpy kernel in
:mod:`gridseries.operators.grouped`; this module is the Catalyst-only
classical variant: centred moving-average trend, per-phase mean seasonal,
remainder. Both produce the same long schema, so strengths and outlier
screens accept either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec
from .series import interpolate
from .windows import trailing_stats

DECOMP_COLUMNS = ("observed", "trend", "seasonal", "resid")


def classical_decompose(series: DataFrame, spec: SeriesSpec, period: int, fill: bool = True) -> DataFrame:
    """Additive decomposition by position (like a two-sided moving average).

    trend: centred MA over ``period`` rows (2 x MA for even periods), NULL
    where the window is incomplete; seasonal: mean detrended value of each
    phase, centred to sum to zero; resid = observed - trend - seasonal.
    Output: (entity, ts, period, observed, trend, seasonal, resid).
    """
    s = interpolate(series, spec) if fill else series
    v = F.col(spec.value)
    half = period // 2
    width = 2 * half + 1
    s = trailing_stats(s.select(spec.entity, spec.ts, spec.value), spec, width)
    w = Window.partitionBy(spec.entity).orderBy("_rn")
    n, total = F.lead("_n", half).over(w), F.lead("_sum", half).over(w)
    if period % 2 == 0:
        # both edges of the even window count half
        total = total - 0.5 * (F.lag(v, half).over(w) + F.lead(v, half).over(w))
    staged = s.select(
        spec.entity,
        spec.ts,
        "_rn",
        v.alias("observed"),
        F.when((F.col("_rn") > half) & (n == width), total / period).alias("trend"),
        F.pmod(F.col("_rn") - 1, F.lit(period)).alias("_phase"),
    )
    staged = staged.withColumn("_pm", F.avg(F.col("observed") - F.col("trend")).over(Window.partitionBy(spec.entity, "_phase")))
    # the first cycle holds each phase once
    centre = F.avg(F.when(F.col("_rn") <= period, F.col("_pm"))).over(Window.partitionBy(spec.entity))
    staged = staged.withColumn("seasonal", F.col("_pm") - centre)
    return staged.select(
        spec.entity,
        spec.ts,
        F.lit(period).alias("period"),
        "observed",
        "trend",
        "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )


def strengths(decomp: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Seasonal and trend strength per (entity, period).

    F = max(0, 1 - var(R) / max(var(X + R), 1e-12)) with population
    variances over non-NULL rows.
    """
    r = F.col("resid")
    fs = 1 - F.var_pop(r) / F.greatest(F.var_pop(F.col("seasonal") + r), F.lit(1e-12))
    ft = 1 - F.var_pop(r) / F.greatest(F.var_pop(F.col("trend") + r), F.lit(1e-12))
    return decomp.groupBy(spec.entity, "period").agg(
        F.greatest(F.lit(0.0), fs).alias("seasonal_strength"),
        F.greatest(F.lit(0.0), ft).alias("trend_strength"),
    )
