"""Autocorrelation at chosen lags and KPSS with a fixed lag, in Catalyst.

The full correlogram (thousands of lags) and the automatic KPSS bandwidth
run as grouped numpy kernels; these SQL forms cover a lag list.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec

# KPSS (trend) critical values and their p-values.
KPSS_CT_CRIT = (0.119, 0.146, 0.176, 0.216)
KPSS_CT_PVAL = (0.10, 0.05, 0.025, 0.01)


def acf_at_lags(series: DataFrame, spec: SeriesSpec, lags: Sequence[int]) -> DataFrame:
    """c_k = sum (x_t - m)(x_{t+k} - m) / sum (x_t - m)^2 by position, NULL rows dropped.

    Output: (entity, lag, acf); a lag of n or more gives NULL (NaN originally).
    """
    x = F.col(spec.value)
    s = series.where(x.isNotNull())
    w = Window.partitionBy(spec.entity).orderBy(spec.ts)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = x - F.avg(x).over(whole)
    staged = s.select(spec.entity, d.alias("_d"), *[F.lead(d, k).over(w).alias(f"_l{k}") for k in lags])
    sums = staged.groupBy(spec.entity).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_den"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_c{k}") for k in lags],
    )
    cols = [
        F.struct(F.lit(k).alias("lag"), F.when(F.col("_n") > k, F.try_divide(F.col(f"_c{k}"), F.col("_den"))).alias("acf"))
        for k in lags
    ]
    return sums.select(spec.entity, F.explode(F.array(*cols)).alias("_r")).select(spec.entity, "_r.lag", "_r.acf")


def kpss_pvalue(stat):
    """Linear interpolation on the trend table, clipped to [0.01, 0.10]."""
    c, p = KPSS_CT_CRIT, KPSS_CT_PVAL
    expr = F.when(stat <= c[0], F.lit(p[0]))
    for i in range(len(c) - 1):
        frac = (stat - c[i]) / (c[i + 1] - c[i])
        expr = expr.when(stat <= c[i + 1], F.lit(p[i]) + frac * (p[i + 1] - p[i]))
    return expr.otherwise(F.lit(p[-1]))


def kpss_fixed_lag(series: DataFrame, spec: SeriesSpec, lags: int, min_obs: int = 100) -> DataFrame:
    """KPSS level-plus-trend statistic with a Bartlett window of ``lags``.

    Residuals of OLS on (1, t), t = 1..n by position; eta = sum S_t^2 / n^2;
    long-run variance s^2 = (sum e^2 + 2 sum_k (1 - k/(L+1)) sum e_t e_{t-k}) / n.
    Fewer than ``min_obs`` rows → NULL (F10).
    """
    x = F.col(spec.value)
    s = series.where(x.isNotNull())
    w = Window.partitionBy(spec.entity).orderBy(spec.ts)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = F.row_number().over(w).cast("double")
    s = s.select(spec.entity, spec.ts, x.alias("_x"), t.alias("_t"))
    fit = s.select(
        "*",
        F.regr_slope("_x", "_t").over(whole).alias("_b"),
        F.regr_intercept("_x", "_t").over(whole).alias("_a"),
    )
    e = F.col("_x") - (F.col("_a") + F.col("_b") * F.col("_t"))
    resid = fit.select(spec.entity, spec.ts, e.alias("_e"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = resid.select(
        spec.entity,
        "_e",
        F.sum("_e").over(running).alias("_S"),
        *[F.lag("_e", k).over(w).alias(f"_e{k}") for k in range(1, lags + 1)],
    )
    agg = staged.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("nobs"),
        F.sum(F.col("_S") * F.col("_S")).alias("_ss"),
        F.sum(F.col("_e") * F.col("_e")).alias("_e2"),
        *[F.sum(F.col("_e") * F.col(f"_e{k}")).alias(f"_p{k}") for k in range(1, lags + 1)],
    )
    n = F.col("nobs").cast("double")
    lrv = F.col("_e2")
    for k in range(1, lags + 1):
        lrv = lrv + 2.0 * (1.0 - k / (lags + 1.0)) * F.coalesce(F.col(f"_p{k}"), F.lit(0.0))
    # a constant series has no long-run variance: NULL rather than a division error
    stat = F.when(F.col("nobs") >= min_obs, F.try_divide(F.col("_ss") / (n * n), F.when(lrv > 0, lrv / n)))
    return agg.select(
        spec.entity,
        "nobs",
        F.lit(lags).alias("lags"),
        stat.alias("kpss_stat"),
    ).withColumn("kpss_pvalue", F.when(F.col("kpss_stat").isNotNull(), kpss_pvalue(F.col("kpss_stat"))))
