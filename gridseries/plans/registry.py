"""Registered queries: one per operator of the inventory, over the driver tables.

Each callable takes (spark, sf_dir) and returns a DataFrame whose columns
match the SQL twin in :mod:`gridseries.plans.oracle`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import forecast as fc
from . import bindings as b
from .present import present

Query = Callable[[SparkSession, str], DataFrame]

S = b.EVENTS_HOURLY
BASELINES = {"naive_last": None, "naive_daily": S.daily, "naive_weekly": S.weekly}


def _test_forecasts(spark, d) -> DataFrame:
    f = fc.baseline_forecasts(b.hourly(spark, d), S, BASELINES)
    return ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end)


def q_forecast_last(spark, d):
    f = fc.last_value(b.hourly(spark, d), S)
    return present(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_forecast_seasonal(spark, d):
    f = fc.baseline_forecasts(b.hourly(spark, d), S, {"naive_daily": S.daily, "naive_weekly": S.weekly})
    return present(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_walkforward_metrics(spark, d):
    return present(ev.metrics_table(_test_forecasts(spark, d), S))


def q_leaderboard(spark, d):
    m = ev.metrics_table(_test_forecasts(spark, d), S, decimals=4)
    return present(ev.leaderboard(m, S).select(S.entity, "model", "MAE", "rank"))


QUERIES: dict[str, Query] = {
    "forecast_last": q_forecast_last,
    "forecast_seasonal": q_forecast_seasonal,
    "walkforward_metrics": q_walkforward_metrics,
    "leaderboard": q_leaderboard,
}


# ---------------------------------------------------------------- ingest
from datetime import datetime  # noqa: E402

from ..functions import time as tf  # noqa: E402
from ..operators import anomalies as an  # noqa: E402
from ..operators import correlation as cor  # noqa: E402
from ..operators import daystate as ds  # noqa: E402
from ..operators import decomposition as dec  # noqa: E402
from ..operators import distribution as dist  # noqa: E402
from ..operators import features as feat  # noqa: E402
from ..operators import harmonic as har  # noqa: E402
from ..operators import series as ser  # noqa: E402
from ..operators import windows as win  # noqa: E402
from ..sources import lines as ln  # noqa: E402

TEN = b.EVENTS_10MIN
C = b.EVENTS_CELLS
O = b.ORDERS_DAILY


def _session_tz(spark) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


def _canonical(spark, d):
    parsed = ln.parse_lines(b.raw_line_files(spark, d), on_bad_row="quarantine")
    return ln.canonicalise(parsed, tz=TEN.tz, session_tz=_session_tz(spark))


def q_canonical_from_lines(spark, d):
    c = _canonical(spark, d)
    wall = F.convert_timezone(F.lit(_session_tz(spark)), F.lit(TEN.tz), F.col("ts").cast("timestamp_ntz"))
    return present(c.select("square_id", wall.alias("ts"), "internet", "day", "year_month"))


def q_ingest_profile(spark, d):
    return present(ln.ingest_profile(b.raw_line_files(spark, d)))


def q_daily_manifest(spark, d):
    c = _canonical(spark, d)
    return present(
        c.groupBy("day", "year_month")
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("square_id").alias("cells"))
        .select("day", "year_month", tf.partition_path(F.col("day")).alias("path"), "rows", "cells")
    )


def q_missing_hours(spark, d):
    return present(ser.missing_bins(b.hourly(spark, d), S))


def q_missing_days(spark, d):
    return present(ser.missing_bins(b.orders_daily(spark, d), O))


# ---------------------------------------------------------------- series algebra
WEEK2 = (datetime(2024, 1, 8, 0, 0), datetime(2024, 1, 14, 23, 0))


def q_area_series(spark, d):
    return present(ser.area_series(b.hourly(spark, d), S, "click"))


def q_areas_wide(spark, d):
    h = b.hourly(spark, d)
    # one column per entity: the list of columns is part of the query, so it is read first
    ids = [r[0] for r in h.select(S.entity).distinct().orderBy(S.entity).collect()]
    return present(ser.areas_wide(h, S, ids))


def _totals(spark, d):
    return ser.area_totals(b.cells_hourly(spark, d), C)


def q_area_totals(spark, d):
    return present(_totals(spark, d))


def q_top_areas(spark, d):
    return present(ser.top_k(_totals(spark, d), C, 5))


def q_resolve_areas(spark, d):
    return present(ser.resolve_areas(spark, "top, 7 ,12,,TOP", _totals(spark, d), C))


def q_split_counts(spark, d):
    h = ser.with_split(b.hourly(spark, d), S, b.SPLIT)
    return present(h.groupBy(S.entity, "split").agg(F.count(F.lit(1)).alias("n"), F.sum(S.value).alias("total")))


def _filled(spark, d):
    reg = ser.regularise(b.hourly(spark, d), S).withColumn("was_missing", F.col(S.value).isNull())
    return ser.interpolate(reg, S)


def q_interpolate(spark, d):
    return present(_filled(spark, d))


def q_rolling_stats(spark, d):
    return present(win.rolling_stats(b.hourly(spark, d), S, S.daily))


def q_preview(spark, d):
    h = ser.area_series(b.hourly(spark, d), S, "view", datetime(2024, 1, 1), None, sort=False)
    first14 = h.where(F.col(S.ts) <= ser.ts_literal(h, S.ts, datetime(2024, 1, 14, 23, 0), S.tz))
    return present(win.preview(first14, S, 6, _session_tz(spark)))


def q_seasonal_diff(spark, d):
    return present(win.differences(b.hourly(spark, d), S, [1, S.daily]))


# ---------------------------------------------------------------- city / spatial
def _grid_totals(spark, d):
    """Totals under 1-based cell ids (user ids start at 0)."""
    return _totals(spark, d).withColumn(C.entity, F.col(C.entity) + 1)


def q_city_stats(spark, d):
    return present(dist.city_stats(_totals(spark, d)))


def q_city_histogram(spark, d):
    return present(dist.histogram(_totals(spark, d), 80))


def q_city_kde(spark, d):
    return present(dist.kde(_totals(spark, d), 400))


def q_spatial_grid(spark, d):
    return present(dist.spatial_grid(_grid_totals(spark, d), spark, C.entity))


def q_spatial_stats(spark, d):
    return present(dist.spatial_stats(_grid_totals(spark, d), C.entity))


def _sparse_totals(spark, d):
    """Totals under ids that lie far apart: every thousandth cell of a grid."""
    return _totals(spark, d).withColumn(C.entity, F.col(C.entity) * 1000 + 1)


def q_spatial_cells(spark, d):
    """Occupied cells of a grid whose ids are sparse (E11, F9): rows follow the entities."""
    return present(dist.occupied_cells(_sparse_totals(spark, d), C.entity))


def q_spatial_tiles(spark, d):
    return present(dist.grid_tiles(dist.occupied_cells(_sparse_totals(spark, d), C.entity), 32))


def _day_state(spark, d) -> str:
    """Daily state of the cells in three runs: the first days, the rest, and one day again."""
    root = stm.scratch(spark, "day-state")
    cells = b.cells_hourly(spark, d)
    day = F.to_date(C.ts)
    for part in (day < F.lit("2024-01-16").cast("date"), day >= F.lit("2024-01-16").cast("date"), day == F.lit("2024-01-10").cast("date")):
        ds.update_days(cells.where(part), C, root, _session_tz(spark))
    return root


def q_city_day_stats(spark, d):
    """Distribution of the cells' daily totals, merged from a row of state for each day."""
    return present(ds.stored_stats(spark, _day_state(spark, d)).drop(*ds.LEVELS))


def q_city_day_ranks(spark, d):
    """Whether the percentiles from merged sketches are within the stated rank error."""
    stats = ds.stored_stats(spark, _day_state(spark, d))
    return ds.ranks_within(ds.day_totals(b.cells_hourly(spark, d), C, _session_tz(spark)), stats)


def q_area_totals_days(spark, d):
    """Totals per cell over all days, from the daily totals (A2)."""
    entity_type = b.cells_hourly(spark, d).schema[C.entity].dataType.simpleString()
    return present(ds.stored_totals(spark, C, _day_state(spark, d), entity_type))


# ---------------------------------------------------------------- EDA in SQL
def q_acf_lags(spark, d):
    return present(cor.acf_at_lags(b.hourly(spark, d), S, [1, S.daily, S.weekly]))


def q_kpss_fixed_lag(spark, d):
    return present(cor.kpss_fixed_lag(b.hourly(spark, d), S, 8))


def q_harmonic_params(spark, d):
    p = har.harmonic_fit(b.hourly(spark, d), S, b.SPLIT)
    flat = p.select(S.entity, "anchor", "use_log", "n_train", "low", "high", "phi1", "phi2", "sigma2", F.posexplode_outer("beta").alias("term", "beta"))
    return present(flat)


def _harmonic(spark, d):
    return har.harmonic_forecasts(b.hourly(spark, d), S, b.SPLIT)


def q_harmonic_forecast(spark, d):
    return present(ev.walk_forward(_harmonic(spark, d), S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_harmonic_metrics(spark, d):
    w = ev.walk_forward(_harmonic(spark, d), S, b.SPLIT.test_start, b.SPLIT.test_end)
    return present(ev.metrics_table(w, S))


def _decomp(spark, d, period):
    return dec.classical_decompose(_filled(spark, d).select(S.entity, S.ts, S.value), S, period, fill=False)


def q_classical_decomposition(spark, d):
    return present(_decomp(spark, d, S.daily))


def q_strengths(spark, d):
    both = _decomp(spark, d, S.daily).unionByName(_decomp(spark, d, S.weekly))
    return present(dec.strengths(both, S))


def q_residual_outliers(spark, d):
    return present(an.residual_outliers(_decomp(spark, d, S.daily), S, 4.0))


def q_drop_runs(spark, d):
    h = _filled(spark, d).select(S.entity, S.ts, S.value)
    # hours 40 % below the day before, two or more in a row: there are some at every scale
    return present(an.drop_runs(h, S, S.daily, 0.4, 2))


# ---------------------------------------------------------------- features
def q_fourier_features(spark, d):
    f = feat.fourier_features(b.hourly(spark, d), S, 4, 3, b.SPLIT)
    return present(f.drop("anchor"))


def q_calendar_features(spark, d):
    return present(feat.calendar_features(b.hourly(spark, d), S, _session_tz(spark)))


def q_scaled_features(spark, d):
    h = b.hourly(spark, d)
    return present(feat.scaled(h, S, feat.fit_scaler(h, S, b.SPLIT)))


def q_lag_windows(spark, d):
    return present(feat.lag_features(b.hourly(spark, d), S, [1, 2, 3, S.daily, S.weekly]))


# ---------------------------------------------------------------- evaluation
MODELS = list(BASELINES)


def q_residual_table(spark, d):
    return present(ev.residual_table(_test_forecasts(spark, d), S, MODELS))


def q_rolling_mae(spark, d):
    return present(ev.rolling_mae(_test_forecasts(spark, d), S, 6))


def _failures(spark, d):
    return ev.joint_failure(_test_forecasts(spark, d), S, 6, 2.0, n_models=len(MODELS))


def q_joint_failure(spark, d):
    f = _failures(spark, d)
    flat = f.select(S.entity, "start", "end", "peak", "severity", F.explode("ratios").alias("model", "ratio"))
    return present(flat)


def q_failure_context(spark, d):
    return present(ev.failure_context(_test_forecasts(spark, d), _failures(spark, d), S, 7200))


QUERIES.update(
    {
        "canonical_from_lines": q_canonical_from_lines,
        "ingest_profile": q_ingest_profile,
        "daily_manifest": q_daily_manifest,
        "missing_hours": q_missing_hours,
        "missing_days": q_missing_days,
        "area_series": q_area_series,
        "areas_wide": q_areas_wide,
        "area_totals": q_area_totals,
        "top_areas": q_top_areas,
        "resolve_areas": q_resolve_areas,
        "split_counts": q_split_counts,
        "interpolate": q_interpolate,
        "rolling_stats": q_rolling_stats,
        "preview": q_preview,
        "seasonal_diff": q_seasonal_diff,
        "city_stats": q_city_stats,
        "city_histogram": q_city_histogram,
        "city_kde": q_city_kde,
        "spatial_grid": q_spatial_grid,
        "spatial_stats": q_spatial_stats,
        "spatial_cells": q_spatial_cells,
        "spatial_tiles": q_spatial_tiles,
        "city_day_stats": q_city_day_stats,
        "city_day_ranks": q_city_day_ranks,
        "area_totals_days": q_area_totals_days,
        "acf_lags": q_acf_lags,
        "kpss_fixed_lag": q_kpss_fixed_lag,
        "classical_decomposition": q_classical_decomposition,
        "strengths": q_strengths,
        "residual_outliers": q_residual_outliers,
        "drop_runs": q_drop_runs,
        "fourier_features": q_fourier_features,
        "calendar_features": q_calendar_features,
        "scaled_features": q_scaled_features,
        "lag_windows": q_lag_windows,
        "residual_table": q_residual_table,
        "rolling_mae": q_rolling_mae,
        "joint_failure": q_joint_failure,
        "failure_context": q_failure_context,
        "harmonic_params": q_harmonic_params,
        "harmonic_forecast": q_harmonic_forecast,
        "harmonic_metrics": q_harmonic_metrics,
    }
)


# ---------------------------------------------------------------- grouped numpy kernels (no SQL twin)
from ..config import DhrConfig  # noqa: E402
from ..operators import grouped as gm  # noqa: E402
from ..operators import lagged as lag  # noqa: E402


def q_stationarity_tests(spark, d):
    return present(lag.stationarity_tests(b.hourly(spark, d), S))


def q_adf_after_diff(spark, d):
    return present(lag.adf_after_difference(b.hourly(spark, d), S, 1, S.daily))


def q_acf_full(spark, d):
    return present(lag.acf_table(b.hourly(spark, d), S, 2 * S.weekly))


def q_pacf(spark, d):
    return present(lag.pacf_table(b.hourly(spark, d), S, 60))


def _stl(spark, d, period):
    return gm.stl_decompose(_filled(spark, d).select(S.entity, S.ts, S.value), S, period, fill=False)


def q_stl(spark, d):
    return present(_stl(spark, d, S.daily))


def q_stl_strengths(spark, d):
    both = _stl(spark, d, S.daily).unionByName(_stl(spark, d, S.weekly))
    return present(dec.strengths(both, S))


def q_stl_outliers(spark, d):
    return present(an.residual_outliers(_stl(spark, d, S.daily), S, 4.0))


DHR = DhrConfig(p=2, q=2, daily_terms=4, weekly_terms=3, use_log1p=True, intercept=True)


def q_dhr_params(spark, d):
    p = gm.dhr_fit(b.hourly(spark, d), S, b.SPLIT, DHR)
    return present(p.select(S.entity, "model", "anchor", "use_log", "n_train", F.size("beta").alias("n_beta"), "sigma2"))


def q_dhr_forecast(spark, d):
    f = gm.dhr_forecasts(b.hourly(spark, d), S, b.SPLIT, DHR)
    return present(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_dhr_metrics(spark, d):
    h = b.hourly(spark, d)
    f = gm.dhr_forecasts(h, S, b.SPLIT, DHR).unionByName(fc.baseline_forecasts(h, S, BASELINES))
    return present(ev.metrics_table(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end), S))


QUERIES.update(
    {
        "stationarity_tests": q_stationarity_tests,
        "adf_after_diff": q_adf_after_diff,
        "acf_full": q_acf_full,
        "pacf": q_pacf,
        "stl": q_stl,
        "stl_strengths": q_stl_strengths,
        "stl_outliers": q_stl_outliers,
        "dhr_params": q_dhr_params,
        "dhr_forecast": q_dhr_forecast,
        "dhr_metrics": q_dhr_metrics,
    }
)


# ---------------------------------------------------------------- learned models, tuning, run log
from ..operators import learned  # noqa: E402
from ..operators import reporting as rep  # noqa: E402
from ..operators import tuning as tun  # noqa: E402


def q_learned_linear(spark, d):
    f = learned.linear_forecasts(b.hourly(spark, d), S, b.SPLIT, _session_tz(spark))
    return present(ev.metrics_table(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end), S))


def q_learned_tree(spark, d):
    f = learned.tree_forecasts(b.hourly(spark, d), S, b.SPLIT, _session_tz(spark))
    return present(ev.metrics_table(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end), S))


NAIVE_TRIALS = {"last": None, "day": S.daily, "two_days": 2 * S.daily, "week": S.weekly}


def q_tuning_naive(spark, d):
    t = tun.naive_trials(b.hourly(spark, d), S, b.SPLIT, NAIVE_TRIALS)
    return present(tun.as_rows(t, ["period"]))


DHR_TRIALS = [
    ("arma11_3_2", DhrConfig(p=1, q=1, daily_terms=3, weekly_terms=2)),
    ("arma22_3_2", DhrConfig(p=2, q=2, daily_terms=3, weekly_terms=2)),
    ("arma22_4_3", DhrConfig(p=2, q=2, daily_terms=4, weekly_terms=3)),
]


def q_tuning_dhr(spark, d):
    t = tun.dhr_trials(b.hourly(spark, d), S, b.SPLIT, DHR_TRIALS)
    return present(tun.as_rows(t, ["p", "q", "daily_terms", "weekly_terms"]).drop("train_seconds"))


def q_run_log_upsert(spark, d):
    f = fc.baseline_forecasts(b.hourly(spark, d), S, BASELINES)
    val = ev.walk_forward(f, S, b.SPLIT.val_start, b.SPLIT.val_end)
    test = ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end)
    old = val.groupBy("model", S.entity).agg(
        F.count(F.lit(1)).alias("steps"), F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("val_MAE")
    )
    new = test.groupBy("model", S.entity).agg(
        F.count(F.lit(1)).alias("steps"), F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("test_MAE")
    )
    return present(rep.upsert(old, new, ["model", S.entity], merge_columns=True))


QUERIES.update(
    {
        "learned_linear": q_learned_linear,
        "learned_tree": q_learned_tree,
        "tuning_naive": q_tuning_naive,
        "tuning_dhr": q_tuning_dhr,
        "run_log_upsert": q_run_log_upsert,
    }
)


# ---------------------------------------------------------------- streaming
from ..streaming import ingest as stm  # noqa: E402


def q_stream_bins(spark, d):
    ev_schema = b.events(spark, d).schema
    # a file stream source watches a folder; the glob keeps it to the events table
    stream = spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet").parquet(d)
    agg = stm.stream_bins(stream, S, "event_type", "ts", "value", watermark="2 hours")
    return present(stm.drain_upserts(agg, [S.entity, S.ts], stm.scratch(spark, "stream-bins")))


def q_stream_online_error(spark, d):
    folder = stm.scratch(spark, "stream-online")
    b.hourly(spark, d).write.mode("overwrite").parquet(f"{folder}/series")
    schema = spark.read.parquet(f"{folder}/series").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/series")
    online = stm.online_forecasts(stream, S, S.daily)
    q = (
        online.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return present(spark.read.schema(online.schema).parquet(f"{folder}/out"))


QUERIES.update({"stream_bins": q_stream_bins, "stream_online_error": q_stream_online_error})


# ---------------------------------------------------------------- whole-grid forms
from ..plans import eda as eda_plan  # noqa: E402
from ..sources import store as st  # noqa: E402


def q_eda_summary(spark, d):
    series = ser.regularise(b.hourly(spark, d), S)
    return present(eda_plan.per_entity_summary(series, S, method="classical"))


def q_cells_walkforward(spark, d):
    """Baselines for every user's hourly series (many sparse series, gaps kept)."""
    f = fc.baseline_forecasts(b.cells_hourly(spark, d), C, {"naive_last": None, "naive_daily": C.daily})
    return present(ev.metrics_table(ev.walk_forward(f, C, b.SPLIT.test_start, b.SPLIT.test_end), C))


_STORES: dict[tuple[str, str], str] = {}


def _store_root(spark, d) -> str:
    """The canonical store written once per application and table folder (K1)."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORES:
        root = stm.scratch(spark, "store")
        st.write_store(_canonical(spark, d), root)
        _STORES[key] = root
    return _STORES[key]


def q_store_partitions(spark, d):
    """Profile the written store from partition metadata."""
    root = _store_root(spark, d)
    prof = st.profile_partitions(spark, root)
    listed = st.list_partitions(spark, root).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "year_month")
    per_day = prof.groupBy("day").agg(
        F.sum("rows").alias("rows"),
        F.min(F.col("bytes") > 0).alias("has_bytes"),
        F.min(F.length("sha256") == 64).alias("has_sha256"),
    )
    return present(listed.join(per_day, "day", "left"))


def q_store_series(spark, d):
    """Every cell's whole series read back from the store."""
    return _stored(spark, d)


def q_store_week(spark, d):
    """Every cell's series read back from the store for one week, partition-pruned."""
    return _stored(spark, d, *WEEK2)


def _stored(spark, d, start=None, end=None):
    s = st.load_series(spark, _store_root(spark, d), start=start, end=end, tz=TEN.tz)
    wall = F.convert_timezone(F.lit(_session_tz(spark)), F.lit(TEN.tz), F.col("ts").cast("timestamp_ntz"))
    return present(s.select("square_id", wall.alias("ts"), "internet"))


QUERIES.update(
    {
        "store_series": q_store_series,
        "store_week": q_store_week,
        "eda_summary": q_eda_summary,
        "cells_walkforward": q_cells_walkforward,
        "store_partitions": q_store_partitions,
    }
)


def q_orders_walkforward(spark, d):
    """Daily order totals per priority: baselines with a weekly season (step 1 day)."""
    f = fc.baseline_forecasts(b.orders_daily(spark, d), O, {"naive_last": None, "naive_weekly": O.weekly})
    w = ev.walk_forward(f, O, b.ORDERS_SPLIT.test_start, b.ORDERS_SPLIT.test_end)
    return present(ev.metrics_table(w, O))


QUERIES["orders_walkforward"] = q_orders_walkforward


def q_sliding_windows(spark, d):
    """The previous day of (z, calendar) rows for every target (W8), one row per
    (target, position in the window)."""
    h = b.hourly(spark, d)
    z = feat.calendar_features(feat.scaled(h, S, feat.fit_scaler(h, S, b.SPLIT)), S, _session_tz(spark))
    w = feat.sliding_windows(z, S, S.daily, ["z", "tod_sin", "tod_cos", "dow_sin", "dow_cos", "is_weekend"])
    flat = w.select(S.entity, S.ts, F.posexplode("window").alias("k", "w")).select(S.entity, S.ts, "k", "w.*")
    return present(flat)


def q_comparison_lines(spark, d):
    """Markdown comparison of the baselines on the test window (K8)."""
    m = ev.leaderboard(ev.metrics_table(_test_forecasts(spark, d), S, decimals=4), S)
    return rep.markdown_table(m, [S.entity, "model", "MAE", "RMSE", "MAPE_percent", "sMAPE_percent"], [S.entity, "rank"])


QUERIES.update({"sliding_windows": q_sliding_windows, "comparison_lines": q_comparison_lines})


def q_kpss_auto(spark, d):
    return present(lag.kpss_table(b.hourly(spark, d), S))


QUERIES["kpss_auto"] = q_kpss_auto


LINEAR_GRID = [
    ("recent6_eps1.35", {"recent": 6, "epsilon": 1.35}),
    ("recent12_eps1.35", {"recent": 12, "epsilon": 1.35}),
    ("recent6_eps2", {"recent": 6, "epsilon": 2.0}),
]


def q_tuning_learned(spark, d):
    t = tun.learned_trials(b.hourly(spark, d), S, b.SPLIT, LINEAR_GRID, "linear", _session_tz(spark))
    rows = tun.as_rows(tun.best_trials(t, S), ["recent", "epsilon"])
    return present(rows.drop("train_seconds"))


QUERIES["tuning_learned"] = q_tuning_learned


def q_stream_incremental(spark, d):
    """Streaming ingest of the day files into a fresh store, read back."""
    folder = stm.scratch(spark, "stream-ingest")
    stm.incremental_ingest(
        spark, b.raw_line_folder(spark, d), f"{folder}/store", f"{folder}/checkpoint", tz=TEN.tz, on_bad_row="quarantine"
    )
    s = st.read_store(spark, f"{folder}/store")
    wall = F.convert_timezone(F.lit(_session_tz(spark)), F.lit(TEN.tz), F.col("ts").cast("timestamp_ntz"))
    return present(s.select("square_id", wall.alias("ts"), "internet", F.date_format("day", "yyyy-MM-dd").alias("day")))


QUERIES["stream_incremental"] = q_stream_incremental


# ---------------------------------------------------------------- whole ingest runs
from ..config import IngestConfig  # noqa: E402
from ..plans import ingest as ing  # noqa: E402


def _two_runs(spark, d):
    """Ingest the first ten days, then the rest, as two runs over the same store; returns the second run's catalog."""
    root = stm.scratch(spark, "two-runs")
    raw = b.raw_line_folder(spark, d)
    cfg = IngestConfig(tz=TEN.tz, expected_first_date="2023-12-30", expected_last_date="2024-02-02")
    ing.run_ingest(spark, raw, root, cfg, limit_days=10)
    return root, ing.run_ingest(spark, raw, root, cfg)


def q_ingest_two_runs(spark, d):
    """Stored rows and quarantined lines of each day after two runs: together they hold every line."""
    root, out = _two_runs(spark, d)
    stored = st.read_store(spark, root).groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.max("square_id").alias("max_id"), F.sum(F.col("internet").cast("double")).alias("total")
    )
    bad = out["quarantine"].groupBy("day").agg(F.count(F.lit(1)).alias("bad_lines"))
    both = stored.join(bad, "day", "full_outer").withColumn("bad_lines", F.coalesce("bad_lines", F.lit(0)))
    return present(both.withColumn("total", F.round("total", 0)))


def q_quarantine_rows(spark, d):
    """Every bad line of both runs with its reason."""
    return present(_two_runs(spark, d)[1]["quarantine"])


def q_ingest_manifest(spark, d):
    """Manifest totals and missing days of the configured calendar after two runs."""
    _, out = _two_runs(spark, d)
    totals = out["manifest"].select("expected_start", "expected_end", "n_partitions", "total_rows")
    missing = out["missing"].agg(F.count(F.lit(1)).alias("n_missing"), F.min("day").alias("first_missing"), F.max("day").alias("last_missing"))
    from ..operators.util import attach_scalars

    return present(attach_scalars(totals, missing))


def q_ingest_catalog(spark, d):
    """Versions of the catalog after two runs: days hashed by each, totals, and files whose stored checksum or size is wrong."""
    from ..sources import catalog as cat

    root, _ = _two_runs(spark, d)
    now = st.file_checksums(spark, root).select(F.concat(F.lit("year_month="), F.substring_index("path", "year_month=", -1)).alias("path"), F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    both = cat.records(spark, root).join(now, "path", "full_outer")
    wrong = both.where(~(F.col("sha256").eqNullSafe(F.col("s")) & F.col("bytes").eqNullSafe(F.col("b")))).agg(F.count(F.lit(1)).alias("wrong_files"))
    from ..operators.util import attach_scalars

    return present(attach_scalars(cat.commits(spark, root).select("version", "hashed_days", "removed_files", "n_partitions", "total_rows"), wrong))


LONG = S.with_(long=True)


def q_long_rolling(spark, d):
    """Rolling statistics with a series cut into chunks."""
    return present(win.rolling_stats(b.hourly(spark, d), LONG, S.daily))


def q_long_interpolate(spark, d):
    """Interpolation across chunks of time."""
    reg = ser.regularise(b.hourly(spark, d), LONG).withColumn("was_missing", F.col(S.value).isNull())
    return present(ser.interpolate(reg, LONG))


def q_long_forecasts(spark, d):
    """As-of and seasonal lookups across chunks of time."""
    f = fc.baseline_forecasts(b.hourly(spark, d), LONG, {"naive_daily": S.daily, "naive_weekly": S.weekly})
    return present(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_long_drop_runs(spark, d):
    """Drop runs joined across chunks."""
    h = ser.interpolate(ser.regularise(b.hourly(spark, d), LONG), LONG).select(S.entity, S.ts, S.value)
    return present(an.drop_runs(h, LONG, S.daily, 0.4, 2))


QUERIES.update(
    {
        "ingest_two_runs": q_ingest_two_runs,
        "quarantine_rows": q_quarantine_rows,
        "ingest_manifest": q_ingest_manifest,
        "ingest_catalog": q_ingest_catalog,
        "long_rolling": q_long_rolling,
        "long_interpolate": q_long_interpolate,
        "long_forecasts": q_long_forecasts,
        "long_drop_runs": q_long_drop_runs,
    }
)


# ---------------------------------------------------------------- the heavy operators over every user's series
def _cells_filled(spark, d):
    reg = ser.regularise(b.cells_hourly(spark, d), C).withColumn("was_missing", F.col(C.value).isNull())
    return ser.interpolate(reg, C)


def q_cells_interpolate(spark, d):
    return present(_cells_filled(spark, d))


def q_cells_rolling(spark, d):
    return present(win.rolling_stats(_cells_filled(spark, d).select(C.entity, C.ts, C.value), C, C.daily))


def q_cells_strengths(spark, d):
    series = _cells_filled(spark, d).select(C.entity, C.ts, C.value)
    return present(dec.strengths(dec.classical_decompose(series, C, C.daily, fill=False), C))


def q_cells_drop_runs(spark, d):
    return present(an.drop_runs(_cells_filled(spark, d).select(C.entity, C.ts, C.value), C, C.daily, 0.6, 6))


QUERIES.update(
    {
        "cells_interpolate": q_cells_interpolate,
        "cells_rolling": q_cells_rolling,
        "cells_strengths": q_cells_strengths,
        "cells_drop_runs": q_cells_drop_runs,
    }
)


# ---------------------------------------------------------------- sinks written and read back
def q_forecast_store(spark, d):
    """Forecasts written per model, read back for requested pairs, absent pairs reported."""
    folder = stm.scratch(spark, "forecasts")
    rep.write_forecasts(_test_forecasts(spark, d), folder, S.entity)
    h = b.hourly(spark, d).select(S.entity).distinct()
    requested = h.withColumn("model", F.explode(F.array(F.lit("naive_last"), F.lit("naive_weekly"), F.lit("not_run"))))
    found, missing = rep.read_forecasts(spark, folder, requested, S.entity)
    counts = found.groupBy("model", S.entity).agg(F.count(F.lit(1)).alias("n"), F.avg("y_pred").alias("mean_pred"))
    absent = missing.select("model", S.entity, F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("mean_pred"))
    return present(counts.unionByName(absent))


def q_metrics_csv(spark, d):
    """Metrics as CSV folders per entity, overwritten by a second run and read back (K5, P5)."""
    folder = stm.scratch(spark, "metrics")
    m = ev.metrics_table(_test_forecasts(spark, d), S, decimals=4)
    rep.write_partitioned_csv(m.withColumn(S.entity, F.concat(S.entity, F.lit("_gone"))), folder, S.entity)
    rep.write_partitioned_csv(m, folder, S.entity)
    back = spark.read.option("header", True).schema(m.drop(S.entity).schema.add(m.schema[S.entity])).csv(folder)
    return present(back.select(S.entity, "model", "n", "MAE", "RMSE"))


def q_anomalies_csv(spark, d):
    """Outliers as CSV folders per entity, read back (K6)."""
    folder = stm.scratch(spark, "anomalies")
    o = an.residual_outliers(_decomp(spark, d, S.daily), S, 3.0).select(S.entity, S.ts, "z")
    rep.write_partitioned_csv(o, folder, S.entity)
    schema = f"{S.ts} timestamp_ntz, z double, {S.entity} string"
    return present(spark.read.option("header", True).schema(schema).csv(folder).select(S.entity, S.ts, "z"))


def q_summary_merge(spark, d):
    """A summary stored, then merged with a later run of other entities and columns."""
    path = stm.scratch(spark, "summary")
    h = b.hourly(spark, d)
    first = h.groupBy(S.entity).agg(F.count(F.lit(1)).alias("n_obs"), F.sum(S.value).alias("total"))
    later = h.where(F.col(S.entity) >= "p").groupBy(S.entity).agg(F.lit(0).cast("bigint").alias("n_obs"), F.max(S.value).alias("top"))
    schema = f"{S.entity} string, n_obs bigint, total double, top double"
    eda_plan.write_summary(first, path, S.entity, schema)
    eda_plan.write_summary(later, path, S.entity, schema)
    return present(rep.read_json_summary(spark, path, schema))


def q_run_log_csv(spark, d):
    """Run log written as CSV and read back."""
    path = stm.scratch(spark, "run-log")
    t = _totals(spark, d)
    log = t.select(
        F.lit("harmonic").alias("model"), F.col(C.entity).alias("square_id"), F.lit(0.5).alias("train_seconds"), F.lit(480).cast("bigint").alias("train_steps"),
        F.col("total").alias("predict_seconds_total"), F.lit(None).cast("double").alias("predict_seconds_per_step_mean"), F.lit(168).cast("bigint").alias("test_steps"),
    )
    rep.write_run_log(log, path)
    return present(rep.read_run_log(spark, path))


def q_upsert_replace(spark, d):
    """Rows whose key is in the batch are dropped whole, others kept, the batch appended."""
    t = _totals(spark, d)
    old = t.select(C.entity, F.col("total"), F.lit("old").alias("run"))
    new = t.where(F.col(C.entity) % 3 == 0).select(C.entity, (F.col("total") * 2).alias("total"), F.lit("new").alias("run"))
    return present(rep.upsert(old, new, [C.entity], merge_columns=False))


def q_top_area_text(spark, d):
    """The top area's id as a text file, read back (K9, T4)."""
    path = stm.scratch(spark, "area-top")
    rep.write_text(ser.top_k(_totals(spark, d), C, 1).select(F.col(C.entity).cast("string").alias("value")), path)
    return spark.read.text(path)


def q_cells_kpss(spark, d):
    """KPSS of every user's series; below 100 observations NULL."""
    return present(cor.kpss_fixed_lag(b.cells_hourly(spark, d), C, 8))


QUERIES.update(
    {
        "forecast_store": q_forecast_store,
        "metrics_csv": q_metrics_csv,
        "anomalies_csv": q_anomalies_csv,
        "summary_merge": q_summary_merge,
        "run_log_csv": q_run_log_csv,
        "upsert_replace": q_upsert_replace,
        "top_area_text": q_top_area_text,
        "cells_kpss": q_cells_kpss,
    }
)


# ---------------------------------------------------------------- step models
from ..operators import stepwise as sw  # noqa: E402


def q_step_last(spark, d):
    """The last value by a step model that sees one entity's rows in order."""
    f = sw.step_forecasts(b.hourly(spark, d), S, sw.LastValue, "naive_last")
    return present(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_step_seasonal(spark, d):
    """Seasonal values by step models with a season of memory."""
    h = b.hourly(spark, d)
    make = lambda period: (lambda: sw.SeasonalValue(period, S.step))
    f = sw.step_forecasts(h, S, make(S.daily), "naive_daily").unionByName(sw.step_forecasts(h, S, make(S.weekly), "naive_weekly"))
    return present(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end))


QUERIES.update({"step_last": q_step_last, "step_seasonal": q_step_seasonal})


# ---------------------------------------------------------------- lag models from shared sums of products
from ..operators import search as sea  # noqa: E402

#: Fixed list of candidates: nested lag sets, the widest also with two penalties.
LAG_MODELS = [
    sea.LagModel("last", (1,)),
    sea.LagModel("recent", (1, 2, 3)),
    sea.LagModel("daily", (1, 2, 3, S.daily)),
    sea.LagModel("weekly", (1, 2, 3, S.daily, S.weekly)),
    sea.LagModel("weekly_ridge", (1, 2, 3, S.daily, S.weekly), 0.1),
    sea.LagModel("weekly_strong", (1, 2, 3, S.daily, S.weekly), 1.0),
]


def q_lag_search(spark, d):
    """Every candidate's validation error, from one read of the lag frame (V8)."""
    lags = sorted({lag for m in LAG_MODELS for lag in m.lags})
    found = sea.search(sea.lag_frame(b.hourly(spark, d), S, b.SPLIT, lags), S, LAG_MODELS, lags)
    return present(found.drop("beta", "candidate"))


def q_lag_search_metrics(spark, d):
    """Test metrics of the candidates chosen on validation."""
    f = sea.searched_forecasts(b.hourly(spark, d), S, b.SPLIT, LAG_MODELS)
    return present(ev.metrics_table(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end), S))


QUERIES.update({"lag_search": q_lag_search, "lag_search_metrics": q_lag_search_metrics})


# ---------------------------------------------------------------- streams out of order, compacted tables, sequence batches
import numpy as np  # noqa: E402

from ..operators import sequences as seq  # noqa: E402
from ..streaming import compacted as comp  # noqa: E402
from ..streaming import ordered as order  # noqa: E402


def q_stream_ordered_error(spark, d):
    """Forecasts of rows that arrive up to twelve hours out of order, in three runs of one stream."""
    folder = stm.scratch(spark, "stream-ordered")
    h = b.hourly(spark, d)
    late = F.pmod(F.hash(S.entity, S.ts), F.lit(12 * 3600))
    arrival = tf.epoch_seconds(h, S.ts) + late
    half = F.lit((datetime(2024, 1, 15) - datetime(1970, 1, 1)).days * 86400)
    # closes the stream: later than every row by more than the delay
    closing = h.groupBy().agg(F.lit(None).cast("string").alias(S.entity), (F.max(S.ts) + F.expr("INTERVAL 2 DAYS")).alias(S.ts), F.lit(None).cast("double").alias(S.value))
    for part in (h.where(arrival < half), h.where(arrival >= half), closing):
        part.write.mode("append").parquet(f"{folder}/series")
        stream = spark.readStream.schema(h.schema).parquet(f"{folder}/series")
        out = order.drain(order.ordered_forecasts(stream, S, S.daily, "12 hours"), folder)
    return present(out)


def q_stream_compacted_bins(spark, d):
    """Hourly sums kept by a stream in three runs; the last brings rows that are more than the delay late (R2)."""
    folder = stm.scratch(spark, "stream-compacted")
    events = b.events(spark, d)
    late = (F.col("event_id") % 20 == 3) & (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.where(first & ~late), events.where(~first & ~late), events.where(late)):
        part.repartition(6, "event_id").write.mode("append").parquet(f"{folder}/events")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/events")
        comp.upsert_bins(stream, S, "event_type", "ts", "value", f"{folder}/bins", delay=15 * 86400, keep=4)
    bins = comp.read_bins(spark, f"{folder}/bins", S, "string").withColumn("late", F.lit(False))
    kept = comp.late_rows(spark, f"{folder}/bins", events.schema)
    return present(bins.unionByName(ser.binned(kept, S, "event_type", "ts", "value").withColumn("late", F.lit(True))))


def _window_scores(x: np.ndarray) -> dict[str, np.ndarray]:
    """Facts of each window of (z, weekend) rows, newest row last."""
    z, weight = x[:, :, 0], np.arange(1.0, x.shape[1] + 1)
    return {"oldest": z[:, 0], "newest": z[:, -1], "mean_z": z.mean(axis=1), "max_z": z.max(axis=1), "weighted": z @ weight / weight.sum(), "weekend": x[:, :, 1].sum(axis=1)}


def q_sequence_scores(spark, d):
    """A model's batch of windows as views: scores of the day before every target."""
    h = b.hourly(spark, d)
    z = feat.calendar_features(feat.scaled(h, S, feat.fit_scaler(h, S, b.SPLIT)), S, _session_tz(spark))
    outputs = "oldest double, newest double, mean_z double, max_z double, weighted double, weekend double"
    return present(seq.sequence_batches(z, S, S.daily, ["z", "is_weekend"], _window_scores, outputs))


QUERIES.update({"stream_ordered_error": q_stream_ordered_error, "stream_compacted_bins": q_stream_compacted_bins, "sequence_scores": q_sequence_scores})


# ---------------------------------------------------------------- trained, named and evaluated models; the store's order; the canonical cast
from ..plans import models as mod  # noqa: E402


def q_trained_metrics(spark, d):
    """The harmonic family trained, saved, read back and evaluated on the test window."""
    folder = stm.scratch(spark, "trained")
    h = b.hourly(spark, d)
    mod.train(h, S, b.SPLIT, folder, ["harmonic"], _session_tz(spark))
    f = mod.forecast_trained(spark, h, S, folder, "harmonic", _session_tz(spark))
    return present(ev.metrics_table(ev.walk_forward(f, S, b.SPLIT.test_start, b.SPLIT.test_end), S))


def q_named_forecasts(spark, d):
    """Forecasts of models taken from the registry by name."""
    h = b.hourly(spark, d)
    last, *others = [fc.get_forecaster(name, S)(h) for name in BASELINES]
    for f in others:
        last = last.unionByName(f)
    return present(ev.walk_forward(last, S, b.SPLIT.test_start, b.SPLIT.test_end))


def q_evaluated_run(spark, d):
    """Named models forecast, stored, evaluated and ranked as one run."""
    folder = stm.scratch(spark, "evaluated")
    f = mod.forecast(spark, b.hourly(spark, d), S, b.SPLIT, list(BASELINES), f"{folder}/forecasts")
    board = mod.evaluate(f, S, f"{folder}/results")["leaderboard"]
    return present(board.select(S.entity, "model", "MAE", "rank"))


def q_store_order(spark, d):
    """Rows of each day's files that do not follow (square_id, ts) order."""
    from pyspark.sql import Window

    rows = st.read_store(spark, _store_root(spark, d)).select("day", "square_id", "ts", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    w = Window.partitionBy("file").orderBy("at")
    key = F.struct("square_id", "ts")
    rows = rows.withColumn("wrong", F.coalesce(key < F.lag(key).over(w), F.lit(False)))
    return present(rows.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.count_if("wrong").alias("out_of_order")))


def q_canonical_cast(spark, d):
    """A table with other types cast to the canonical columns."""
    raw = b.events(spark, d).select("event_id", F.col("user_id").cast("int").alias("square_id"), "ts", F.col("value").cast("string").alias("internet"))
    c = ln.to_canonical(raw, tz=TEN.tz, session_tz=_session_tz(spark))
    wall = F.convert_timezone(F.lit(_session_tz(spark)), F.lit(TEN.tz), F.col("ts").cast("timestamp_ntz"))
    return present(c.select("square_id", wall.alias("ts"), "internet"))


QUERIES.update(
    {
        "trained_metrics": q_trained_metrics,
        "named_forecasts": q_named_forecasts,
        "evaluated_run": q_evaluated_run,
        "store_order": q_store_order,
        "canonical_cast": q_canonical_cast,
    }
)
