"""Correlograms and stationarity tests from sums of lagged products.

Every chunk of a series, with the last rows of the chunk before, yields its own sums; adding them up gives those of the whole
series, so one long series is the work of many tasks and no task holds a series. What remains for an entity is a small solve on a
fixed number of sums. Rows without a value are left out first, and lags count rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SeriesSpec
from ..kernels import stationarity as st
from ..kernels.correlation import Z975, durbin_levinson
from . import chunks as ch
from .chunks import CHUNK, POS, chunk_arrays, trended
from .correlation import kpss_pvalue
from .util import staged
from .windows import looking_back

MIN_OBS = st.MIN_OBS
NAN = float("nan")
_SUMS = T.ArrayType(T.DoubleType())


def _numbers(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


@F.pandas_udf(_SUMS)
def _products(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Sums of x_t x_{t-k} over a chunk's own rows t, for k = 0..most."""
    for xs, halos, most in batches:
        yield pd.Series([_own_products(np.asarray(x, float), h, m) for x, h, m in zip(xs, halos, most, strict=True)])


def _own_products(x: np.ndarray, halo: int, most: int) -> list[float]:
    own = x[halo:]
    out = [float(own @ own)]
    for k in range(1, most + 1):
        skip = max(0, k - halo)  # the first rows of a series have no row k back
        out.append(float(own[skip:] @ x[halo + skip - k : len(x) - k]) if skip < len(own) else 0.0)
    return out


def lag_sums(rows: DataFrame, spec: SeriesSpec, value: Column, most: int | Column) -> DataFrame:
    """(entity, lag, c): sums of the products of ``value`` with itself ``lag`` rows back, for lags 0 to ``most`` (of the entity). ``rows`` have a ``_pos``."""
    rows = rows.withColumn("_most", F.lit(most) if isinstance(most, int) else most)
    size = F.greatest(F.lit(ch.CHUNK_STEPS), F.col("_most"))
    chunks = chunk_arrays(rows, spec, value, ["_most"], F.col("_most"), size)
    sums = chunks.select(spec.entity, F.posexplode(_products("xs", "halo", "_most")).alias("lag", "c"))
    return sums.groupBy(spec.entity, F.col("lag").cast("long").alias("lag")).agg(F.sum("c").alias("c"))


def _entities(series: DataFrame, rows: DataFrame, spec: SeriesSpec, *columns: str) -> DataFrame:
    """One row for each entity of ``series``: how many values it has (0 too), and columns of ``rows`` that are alike in an entity."""
    known = rows.where(F.col(POS) == 0).select(F.col(spec.entity).alias("_e"), "_n", *columns)
    every = series.select(spec.entity).distinct()
    out = every.join(known, every[spec.entity].eqNullSafe(F.col("_e")), "left").drop("_e")
    return out.withColumn("_n", F.coalesce("_n", F.lit(0)))


def _joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that matches null entities too."""
    return left.join(right.withColumnRenamed(key, "_key"), left[key].eqNullSafe(F.col("_key")), "left").drop("_key")


def _acf(series: DataFrame, rows: DataFrame, spec: SeriesSpec, most: Column) -> DataFrame:
    """(entity, _n, lag, acf): NaN at lag 0 for fewer than two values, NaN everywhere without variance."""
    sums = lag_sums(rows.withColumn("_last", F.least(most, F.col("_n") - 1)), spec, F.col("_x") - F.col("_mean"), F.col("_last"))
    whole = Window.partitionBy(spec.entity)
    zero = F.max(F.when(F.col("lag") == 0, F.col("c"))).over(whole)
    ratios = sums.select(spec.entity, "lag", F.when(zero > 0, F.col("c") / zero).otherwise(F.lit(NAN)).alias("acf"))
    out = _joined(_entities(series, rows, spec), ratios, spec.entity)
    out = out.where("_n >= 2 OR coalesce(lag, 0) = 0").withColumn("lag", F.coalesce("lag", F.lit(0).cast("long")))
    return out.withColumn("acf", F.when(F.col("_n") >= 2, F.col("acf")).otherwise(F.lit(NAN)))


def acf_table(series: DataFrame, spec: SeriesSpec, nlags: int) -> DataFrame:
    """Full correlogram with the 95 % Bartlett band (E9): (entity, lag, acf, band), lags 0 to min(nlags, n - 1).

    An entity with fewer than two values has one row, lag 0 with NaN.
    """
    rows = trended(series, spec)
    acf = _acf(series, rows, spec, F.lit(nlags))
    before = Window.partitionBy(spec.entity).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(0.0)).over(before), F.lit(0.0))
    spread = F.when(F.col("lag") == 0, 0.0).otherwise(F.sqrt((1 + 2 * squares) / F.col("_n")))
    band = F.when(F.col("_n") >= 2, Z975 * spread).otherwise(F.lit(NAN))
    return acf.select(spec.entity, "lag", "acf", band.alias("band"))


@F.pandas_udf(_SUMS)
def _partial(acfs: pd.Series) -> pd.Series:
    return acfs.map(lambda r: durbin_levinson(np.asarray(r, float)).tolist())


def pacf_table(series: DataFrame, spec: SeriesSpec, nlags: int = 60) -> DataFrame:
    """PACF by Yule-Walker (biased) with its 95 % half-width (E10): (entity, lag, pacf, band), lags 0 to min(nlags, n // 2 - 1)."""
    rows = trended(series, spec)
    most = F.greatest(F.lit(0), F.least(F.lit(nlags), F.floor(F.col("_n") / 2).cast("int") - 1))
    acf = _acf(series, rows, spec, most)
    one = acf.groupBy(spec.entity, "_n").agg(F.sort_array(F.collect_list(F.struct("lag", "acf"))).alias("_r"))
    out = one.select(spec.entity, "_n", F.posexplode(_partial(F.transform("_r", lambda r: r["acf"]))).alias("lag", "pacf"))
    return out.select(spec.entity, F.col("lag").cast("long").alias("lag"), F.coalesce("pacf", F.lit(NAN)).alias("pacf"), F.try_divide(F.lit(Z975), F.sqrt(F.col("_n").cast("double"))).alias("band"))


def _detrended() -> Column:
    """What the least-squares line leaves; the Dickey-Fuller statistic, which has a constant and a trend of its own, is the same for it."""
    return F.col("_x") - F.col("_mean") - F.col("_slope") * (F.col(POS) - (F.col("_n") - 1) / 2.0)


# ---------------------------------------------------------------- KPSS
@F.pandas_udf(_numbers("m", "s", "c", "c2"))
def _running(xs: pd.Series, halos: pd.Series) -> pd.DataFrame:
    """Of a chunk's own rows: number, sum, and the sum of its running sums and of their squares."""
    out = []
    for x, h in zip(xs, halos, strict=True):
        own = np.asarray(x, float)[h:]
        sums = np.cumsum(own)
        out.append((len(own), own.sum(), sums.sum(), sums @ sums))
    return pd.DataFrame(out, columns=["m", "s", "c", "c2"], dtype=float)


def _kpss(series: DataFrame, rows: DataFrame, spec: SeriesSpec, lags: int | None) -> DataFrame:
    """(entity, kpss_stat, kpss_pvalue, kpss_lags); NaN below MIN_OBS values or without variance."""
    long_enough = rows.where(F.col("_n") >= MIN_OBS)
    e, n = _detrended(), F.col("_n").cast("double")
    if lags is None:
        # bandwidth of Hobijn, Franses and Ooms (1998) from the first n^(2/9) lag products
        first = F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("long")
        p = lag_sums(long_enough.withColumn("_first", first), spec, e, F.col("_first"))
        level = F.sum(F.when(F.col("lag") == 0, F.col("c")).otherwise(2 * F.col("c")))
        ratio = p.groupBy(spec.entity).agg(F.try_divide(F.sum(2 * F.col("lag") * F.col("c")), level).alias("_ratio"))
        width = F.floor(1.1447 * F.pow(F.col("_ratio") * F.col("_ratio") * n, F.lit(1.0 / 3.0))).cast("long")
    else:
        ratio, width = long_enough.select(spec.entity).distinct().withColumn("_ratio", F.lit(0.0)), F.lit(lags).cast("long")
    sized = _joined(_entities(series, rows, spec), ratio, spec.entity)
    sized = staged(sized.withColumn("_width", F.when((F.col("_n") >= MIN_OBS) & F.col("_ratio").isNotNull(), F.least(width, F.col("_n") - 1))), "kpss-width")  # small: a row for each entity
    at = long_enough.join(sized.select(F.col(spec.entity).alias("_e"), "_width"), long_enough[spec.entity].eqNullSafe(F.col("_e"))).where("_width IS NOT NULL")
    size = F.greatest(F.lit(ch.CHUNK_STEPS).cast("long"), F.col("_width"))
    chunks = chunk_arrays(at, spec, e, ["_width"], F.col("_width"), size).withColumn("_p", _products("xs", "halo", "_width")).withColumn("_r", _running("xs", "halo"))
    chunks = staged(chunks.select(spec.entity, CHUNK, "_width", "_p", "_r.*"), "kpss-chunks")
    weight = F.when(F.col("lag") == 0, 1.0).otherwise(2.0 * (1.0 - F.col("lag") / (F.col("_width") + 1.0)))
    variance = chunks.select(spec.entity, "_width", F.posexplode("_p").alias("lag", "c")).groupBy(spec.entity).agg(F.sum(weight * F.col("c")).alias("_lrv"))
    before = Window.partitionBy(spec.entity).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("s").over(before), F.lit(0.0))
    eta = chunks.select(spec.entity, (start * start * F.col("m") + 2 * start * F.col("c") + F.col("c2")).alias("_s2")).groupBy(spec.entity).agg(F.sum("_s2").alias("_eta"))
    out = _joined(_joined(sized, variance, spec.entity), eta, spec.entity)
    stat = F.try_divide(F.col("_eta") / (n * n), F.when(F.col("_lrv") > 0, F.col("_lrv") / n))
    out = out.withColumn("kpss_stat", F.coalesce(stat, F.lit(NAN)))
    fine = ~F.isnan("kpss_stat")
    return out.select(
        spec.entity,
        "kpss_stat",
        F.when(fine, kpss_pvalue(F.col("kpss_stat"))).otherwise(F.lit(NAN)).alias("kpss_pvalue"),
        F.when(fine, F.col("_width").cast("double")).otherwise(F.lit(NAN)).alias("kpss_lags"),
    )


def kpss_table(series: DataFrame, spec: SeriesSpec, lags: int | None = None) -> DataFrame:
    """KPSS (trend) per entity, automatic bandwidth unless ``lags`` is given (E4): (entity, kpss_stat, kpss_pvalue, kpss_lags)."""
    return _kpss(series, trended(series, spec), spec, lags)


# ---------------------------------------------------------------- ADF
def _vectors(x: np.ndarray, at: np.ndarray, first: int, n: int, most: int) -> np.ndarray:
    """Rows (1, trend, level, differences 1..most back, difference) of the regression at positions ``at``; ``x`` begins at position ``first``."""
    dx = np.diff(x)
    i = at - first
    lagged = [dx[i - 1 - k] for k in range(1, most + 1)]
    return np.column_stack([np.ones(len(at)), (at - n / 2) / n, x[i - 1], *lagged, dx[i - 1]])


@F.pandas_udf(_SUMS)
def _gram(xs: pd.Series, firsts: pd.Series, halos: pd.Series, ns: pd.Series, most: pd.Series) -> pd.Series:
    """Upper triangle of the sums of products of a chunk's own regression rows that have all ``most`` differences."""
    out = []
    for x, first, h, n, lags in zip(xs, firsts, halos, ns, most, strict=True):
        x = np.asarray(x, float)
        at = np.arange(max(first + h, lags + 1), first + len(x))
        z = _vectors(x, at, first, n, lags) if len(at) else np.zeros((0, lags + 4))
        out.append((z.T @ z)[np.triu_indices(lags + 4)].tolist())
    return pd.Series(out)


def _pivots(gram: np.ndarray, columns: int) -> np.ndarray:
    """Sum of squares left of the last variable after eliminating the first ``columns`` others one by one; a column that depends on others takes nothing."""
    m, left = gram.copy(), []
    for i in range(columns):
        if m[i, i] > 1e-11 * max(gram[i, i], 1e-300):
            m = m - np.outer(m[:, i], m[i]) / m[i, i]
        left.append(m[-1, -1])
    return np.array(left)


def _adf(gram: np.ndarray, head: np.ndarray, n: int, most: int) -> tuple[float, float, float, float]:
    """(tau, p-value, lags, rows) from the sums over rows with all ``most`` differences and the first values of the series."""
    rows = n - 1 - most
    left = np.maximum(_pivots(gram, 3 + most)[2:], 1e-300)
    aic = rows * (math.log(2 * math.pi) + np.log(left / rows) + 1) + 2 * np.arange(3, 4 + most)
    lag = int(np.argmin(aic))
    use = [*range(3 + lag), 3 + most]
    extra = _vectors(head, np.arange(lag + 1, most + 1), 0, n, lag) if most > lag else np.zeros((0, lag + 4))
    g = gram[np.ix_(use, use)] + extra.T @ extra
    m, k = n - 1 - lag, 3 + lag
    scale = np.sqrt(np.maximum(np.diag(g), 1e-300))
    inverse = np.linalg.pinv(g[:k, :k] / np.outer(scale[:k], scale[:k]), hermitian=True) / np.outer(scale[:k], scale[:k])
    beta = inverse @ g[:k, -1]
    rest = max(g[-1, -1] - beta @ g[:k, -1], 0.0)
    variance = rest / (m - k) * inverse[2, 2]
    tau = float(beta[2] / math.sqrt(variance)) if variance > 0 else NAN
    return tau, st.adf_pvalue(tau), float(lag), float(m)


@F.pandas_udf(_numbers("tau", "pvalue", "usedlag", "nobs"))
def _adf_solve(sums: pd.Series, ns: pd.Series, most: pd.Series) -> pd.DataFrame:
    """From the upper triangle of the sums of products, followed by the first values of the series."""
    out = []
    for flat, n, lags in zip(sums, ns, most, strict=True):
        gram, at = np.zeros((lags + 4, lags + 4)), np.triu_indices(lags + 4)
        gram[at] = flat[: len(at[0])]
        out.append(_adf(gram + np.triu(gram, 1).T, np.asarray(flat[len(at[0]) :], float), n, lags))
    return pd.DataFrame(out, columns=["tau", "pvalue", "usedlag", "nobs"], dtype=float)


def _adf_table(series: DataFrame, rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(entity, n_obs, adf_stat, adf_pvalue, adf_usedlag, adf_nobs); NaN below MIN_OBS values."""
    n = F.col("_n")
    most = F.least(F.floor(n / 2).cast("long") - 3, F.ceil(12 * F.pow(n / 100.0, F.lit(0.25))).cast("long"))
    at = rows.where(n >= MIN_OBS).withColumn("_most", most)
    size = F.greatest(F.lit(ch.CHUNK_STEPS).cast("long"), F.col("_most") + 1)
    chunks = chunk_arrays(at, spec, _detrended(), ["_n", "_most"], F.col("_most") + 1, size)
    # the first values of the series, which only the first chunk has, are added up like the sums before them
    span = (F.col("_most") + 1).cast("int")
    head = F.when(F.col("first") == 0, F.slice("xs", F.lit(1), span)).otherwise(F.array_repeat(F.lit(0.0), span))
    cells = chunks.select(spec.entity, "_n", "_most", F.posexplode(F.concat(_gram("xs", "first", "halo", "_n", "_most"), head)).alias("i", "v"))
    cells = cells.groupBy(spec.entity, "_n", "_most", "i").agg(F.sum("v").alias("v"))
    sums = cells.groupBy(spec.entity, "_n", "_most").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("_c"))
    solved = sums.withColumn("_t", _adf_solve(F.transform("_c", lambda c: c["v"]), "_n", "_most"))
    out = _joined(_entities(series, rows, spec), solved.select(spec.entity, "_t"), spec.entity)
    pick = lambda name, out: F.coalesce(F.col(f"_t.{name}"), F.lit(NAN)).alias(out)
    return out.select(spec.entity, F.col("_n").alias("n_obs"), pick("tau", "adf_stat"), pick("pvalue", "adf_pvalue"), pick("usedlag", "adf_usedlag"), pick("nobs", "adf_nobs"))


def _variants(series: DataFrame, spec: SeriesSpec, lags: Sequence[int]) -> tuple[DataFrame, DataFrame, SeriesSpec]:
    """The levels (lag 0) and positional differences as series of (entity, lag), and their rows in place."""
    series = series.select(spec.entity, spec.ts, spec.value)
    cols = {f"_d{k}": F.col(spec.value) - F.lag(spec.value, k).over(ch.by_chunk(spec)) if k else F.col(spec.value) for k in lags}
    wide = looking_back(series, spec, max(lags), **cols) if any(lags) else series.withColumns(cols)
    long = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_d{k}").alias("v")) for k in lags]))
    rows = wide.select(spec.entity, spec.ts, long.alias("_l")).select(F.struct(F.col(spec.entity).alias("e"), F.col("_l.lag").alias("lag")).alias("_series"), spec.ts, F.col("_l.v").alias(spec.value))
    variant = spec.with_(entity="_series")
    return rows, trended(rows, variant), variant


def _adf_of_variants(rows: DataFrame, places: DataFrame, variant: SeriesSpec, spec: SeriesSpec) -> DataFrame:
    """ADF of all variants in one pass: (entity, lag, n_obs, adf_*)."""
    out = _adf_table(rows, places, variant)
    return out.select(F.col("_series.e").alias(spec.entity), F.col("_series.lag").alias("lag"), *[c for c in out.columns if c != "_series"])


def stationarity_tests(series: DataFrame, spec: SeriesSpec, kpss_lags: int | None = None, diff_lags: Sequence[int] = ()) -> DataFrame:
    """ADF (constant + trend, AIC lag) and KPSS (trend) per entity (E3, E4, E5), and ADF after positional differencing at ``diff_lags``.

    Output: (entity, n_obs, adf_stat, adf_pvalue, adf_usedlag, adf_nobs, kpss_stat, kpss_pvalue,
    kpss_lags[, adf_stat_diff<k>, adf_p_diff<k>]); NaN below 100 values.
    """
    series = staged(series.select(spec.entity, spec.ts, spec.value), "stationarity")
    variants = _variants(series, spec, [0, *diff_lags])
    adf = _adf_of_variants(*variants, spec)
    pick = lambda k, c, out: F.max(F.when(F.col("lag") == k, F.col(c))).alias(out)
    names = ("n_obs", "adf_stat", "adf_pvalue", "adf_usedlag", "adf_nobs")
    diffs = [p for k in diff_lags for p in (pick(k, "adf_stat", f"adf_stat_diff{k}"), pick(k, "adf_pvalue", f"adf_p_diff{k}"))]
    one = adf.groupBy(spec.entity).agg(*[pick(0, c, c) for c in names], *diffs)
    levels, places = (t.where("_series.lag = 0") for t in variants[:2])
    kpss = _kpss(levels, places, variants[2], kpss_lags).withColumn("_series", F.col("_series.e")).withColumnRenamed("_series", spec.entity)
    out = _joined(one, kpss, spec.entity)
    more = [c for k in diff_lags for c in (f"adf_stat_diff{k}", f"adf_p_diff{k}")]
    return out.select(spec.entity, *names, "kpss_stat", "kpss_pvalue", "kpss_lags", *more)


def adf_after_difference(series: DataFrame, spec: SeriesSpec, *lags: int) -> DataFrame:
    """Positional difference at each lag, then ADF (E6): (entity, lag, adf_stat_diff, adf_p_diff)."""
    t = _adf_of_variants(*_variants(staged(series.select(spec.entity, spec.ts, spec.value), "differences"), spec, lags), spec)
    return t.select(spec.entity, "lag", F.col("adf_stat").alias("adf_stat_diff"), F.col("adf_pvalue").alias("adf_p_diff"))
