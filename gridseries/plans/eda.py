"""The EDA command as DataFrames for every entity at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EdaConfig, SeriesSpec
from ..operators import anomalies as an
from ..operators import correlation as cor
from ..operators import decomposition as dec
from ..operators import distribution as dist
from ..operators import grouped as gm
from ..operators import lagged as lag
from ..operators import series as ser
from ..operators import windows as win
from ..operators.util import staged


def _decompose(method: str):
    return gm.stl_decompose if method == "stl" else dec.classical_decompose


def daily_decomposition(series: DataFrame, spec: SeriesSpec, method: str = "classical") -> DataFrame:
    """The decomposition at the daily period, staged because several results read it."""
    return staged(_decompose(method)(series.select(spec.entity, spec.ts, spec.value), spec, spec.daily), "eda-daily")


def per_entity_summary(series: DataFrame, spec: SeriesSpec, cfg: EdaConfig = EdaConfig(), method: str = "classical", daily: DataFrame | None = None) -> DataFrame:
    """One row per entity: n_obs, ADF / KPSS, ADF after first and seasonal
    difference, seasonal / trend strengths (daily, weekly), ACF at the daily
    and weekly lag, outlier and drop-run counts (E5, E6, E8, E9, E12, E13).

    The canonical series is staged once because every branch reads it; the
    daily decomposition is computed once and shared by strengths and the
    outlier screen. ``method`` picks the classical variant or robust STL; ``daily`` is that
    decomposition if the caller has it.
    """
    s = staged(series.select(spec.entity, spec.ts, spec.value), "eda-series")
    filled = ser.interpolate(s, spec)
    daily = daily_decomposition(s, spec, method) if daily is None else daily
    weekly = _decompose(method)(filled, spec, spec.weekly, fill=False)
    stren = dec.strengths(daily.unionByName(weekly), spec)
    # one pivot, so each decomposition is evaluated once
    st = stren.groupBy(spec.entity).pivot("period", [spec.daily, spec.weekly]).agg(
        F.first("seasonal_strength").alias("s"), F.first("trend_strength").alias("t")
    )
    st = st.select(
        spec.entity,
        F.col(f"{spec.daily}_s").alias("seasonal_strength_daily"),
        F.col(f"{spec.daily}_t").alias("trend_strength_daily"),
        F.col(f"{spec.weekly}_s").alias("seasonal_strength_weekly"),
        F.col(f"{spec.weekly}_t").alias("trend_strength_weekly"),
    )
    # levels and both differences tested in one grouped pass
    tests = lag.stationarity_tests(s, spec, diff_lags=(1, spec.daily)).withColumnsRenamed(
        {
            f"adf_stat_diff{spec.daily}": "adf_stat_diff_daily",
            f"adf_p_diff{spec.daily}": "adf_p_diff_daily",
        }
    )
    acf = cor.acf_at_lags(s, spec, [spec.daily, spec.weekly]).groupBy(spec.entity).pivot("lag", [spec.daily, spec.weekly]).agg(F.first("acf"))
    acf = acf.select(spec.entity, F.col(str(spec.daily)).alias("acf_daily"), F.col(str(spec.weekly)).alias("acf_weekly"))
    outl = an.residual_outliers(daily, spec, cfg.outlier_z).groupBy(spec.entity).agg(F.count(F.lit(1)).alias("outliers_count"))
    drops = an.drop_runs(s, spec, spec.weekly, cfg.drop_threshold, cfg.drop_min_run).groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("drop_runs_count")
    )
    out = tests
    for part in (st, acf):
        out = out.join(part, spec.entity, "left")
    for part in (outl, drops):
        out = out.join(part, spec.entity, "left")
    return out.fillna(0, subset=["outliers_count", "drop_runs_count"])


def overview(totals: DataFrame, spark: SparkSession, entity: str, side: int | None = None) -> dict[str, DataFrame]:
    """City distribution, histogram, density and spatial grid.

    The totals (one row per entity, derived from the whole store) feed five
    outputs, so they are computed once and kept.
    """
    totals = staged(totals, "eda-totals")
    grid = dist.spatial_grid(totals, spark, entity, side)
    return {
        "city_stats": dist.city_stats(totals),
        "histogram": dist.histogram(totals),
        "kde": dist.kde(totals),
        "grid": grid,
        "spatial": dist.spatial_stats(totals, entity),
    }


def write_summary(summary: DataFrame, path: str, key: str, schema: str | None = None) -> DataFrame:
    """Merge a new per-entity summary into the one stored at ``path`` and replace it.

    Entities of this run win, entities only in the previous file are kept; a
    corrupt or absent previous file counts as empty. The merged result is
    staged in ``spark.checkpoint.dir`` before the folder it was
    read from is replaced, so the write never reads its own output.
    """
    from ..operators import reporting as rep

    spark = summary.sparkSession
    ddl = schema or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in summary.schema.fields)
    previous = rep.read_json_summary(spark, path, ddl)
    merged = staged(rep.merge_summary(previous, summary, key), "summary")
    # readers see the old folder or the new one: written beside it, then renamed
    rep.replace_folder(spark, lambda to: merged.write.json(to), path)
    return merged


def multi_area_preview(series: DataFrame, spec: SeriesSpec, ids, start, days: int = 14, window: int = 6, session_tz: str = "UTC") -> DataFrame:
    """First ``days`` days of the chosen entities with a trailing moving average
    and weekend flag (E2). The end bound is start + days - one step."""
    from datetime import timedelta

    from ..operators.windows import preview

    end = start + timedelta(days=days) - timedelta(seconds=spec.step)
    cond = F.col(spec.entity).isin(list(ids))
    cond = cond & F.col(spec.ts).between(ser.ts_literal(series, spec.ts, start, spec.tz), ser.ts_literal(series, spec.ts, end, spec.tz))
    return preview(series.where(cond), spec, window, session_tz)


def run_eda(series: DataFrame, spec: SeriesSpec, out_dir: str, cfg: EdaConfig = EdaConfig(), method: str = "classical", grid_side: int | None = None) -> dict[str, DataFrame]:
    """The EDA command over every entity (E14): summary merged into the previous
    one (K7), outliers of the daily remainder as CSV per entity (K6), the top entity
    as text (K9) and the city overview tables as JSON (E1, E11)."""
    import os

    from ..operators import reporting as rep

    spark = series.sparkSession
    daily = daily_decomposition(series, spec, method)
    summary = write_summary(per_entity_summary(series, spec, cfg, method, daily), os.path.join(out_dir, "eda_summary"), spec.entity)
    outliers = an.residual_outliers(daily, spec, cfg.outlier_z)
    rep.write_partitioned_csv(outliers, os.path.join(out_dir, "anomalies"), spec.entity)
    totals = ser.area_totals(series, spec)
    top = ser.top_k(totals, spec, 1).select(F.col(spec.entity).cast("string").alias("value"))
    rep.write_text(top, os.path.join(out_dir, "area_top"))
    ov = overview(totals, spark, spec.entity, grid_side)
    ov["rolling"] = win.rolling_stats(series.select(spec.entity, spec.ts, spec.value), spec, cfg.rolling_window)
    ov["drop_runs"] = an.drop_runs(series.select(spec.entity, spec.ts, spec.value), spec, spec.weekly, cfg.drop_threshold, cfg.drop_min_run)
    for name in ("city_stats", "spatial", "histogram", "kde"):  # a fixed number of rows
        ov[name].coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, name))
    for name in ("grid", "rolling", "drop_runs"):
        ov[name].write.mode("overwrite").parquet(os.path.join(out_dir, name))
    return {"summary": summary, "outliers": outliers, **ov}
