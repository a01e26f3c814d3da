"""Model features as columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec, Split
from ..functions import time as tf
from .series import split_label


def with_anchor(series: DataFrame, spec: SeriesSpec, split: Split | None = None, out: str = "anchor") -> DataFrame:
    """Epoch seconds of the first training row of each entity (the Fourier origin).

    Without a split the first row of the series is the anchor.
    """
    t = tf.epoch_seconds(series, spec.ts)
    cond = t if split is None else F.when(split_label(series, spec, split) == "train", t)
    return series.withColumn(out, F.min(cond).over(Window.partitionBy(spec.entity)))


def fourier_columns(step, period: int, terms: int) -> list:
    """sin and cos of 2 pi k step / period for k = 1..terms, in pairs (G1)."""
    out = []
    for k in range(1, terms + 1):
        arg = F.lit(2.0 * math.pi * k / period) * step
        out += [F.sin(arg), F.cos(arg)]
    return out


def fourier_terms(series: DataFrame, spec: SeriesSpec, period: int, terms: int, anchor: str = "anchor", prefix: str | None = None) -> DataFrame:
    """sin/cos(2 pi k s / period), k = 1..terms, s = floor((ts - anchor) / step) (G1)."""
    prefix = prefix or f"p{period}"
    s = tf.step_index(series, spec.ts, spec.step, F.col(anchor)).cast("double")
    names = [f"{prefix}_{f}{k}" for k in range(1, terms + 1) for f in ("sin", "cos")]
    return series.select("*", *[c.alias(n) for c, n in zip(fourier_columns(s, period, terms), names, strict=True)])


def fourier_features(series: DataFrame, spec: SeriesSpec, daily_terms: int = 4, weekly_terms: int = 3, split: Split | None = None) -> DataFrame:
    """Daily then weekly Fourier pairs from one anchor per entity."""
    s = with_anchor(series, spec, split)
    s = fourier_terms(s, spec, spec.daily, daily_terms, prefix="daily")
    return fourier_terms(s, spec, spec.weekly, weekly_terms, prefix="weekly")


def calendar_features(series: DataFrame, spec: SeriesSpec, session_tz: str = "UTC") -> DataFrame:
    """sin/cos of slot of day, sin/cos of day of week (Mon = 0), weekend flag.

    Computed on local wall-clock time in ``spec.tz``.
    """
    wall = tf.wallclock(series, spec.ts, spec.tz, session_tz)
    slots = 86400 // spec.step if spec.step < 86400 else 1
    slot = tf.slot_of_day(wall, spec.step).cast("double")
    dow = tf.weekday_mon0(wall).cast("double")
    two_pi = 2.0 * math.pi
    return series.select(
        "*",
        F.sin(F.lit(two_pi / slots) * slot).alias("tod_sin"),
        F.cos(F.lit(two_pi / slots) * slot).alias("tod_cos"),
        F.sin(F.lit(two_pi / 7.0) * dow).alias("dow_sin"),
        F.cos(F.lit(two_pi / 7.0) * dow).alias("dow_cos"),
        (dow >= 5).cast("double").alias("is_weekend"),
    )


def fit_scaler(series: DataFrame, spec: SeriesSpec, split: Split | None = None) -> DataFrame:
    """Per-entity mean and population std on training rows; std < 1e-9 → 1.

    A small table (one row per entity) joined back on the entity key.
    """
    rows = series if split is None else series.where(split_label(series, spec, split) == "train")
    v = F.col(spec.value)
    agg = rows.where(v.isNotNull()).groupBy(spec.entity).agg(F.avg(v).alias("scale_mean"), F.stddev_pop(v).alias("_sd"))
    return agg.select(
        spec.entity,
        "scale_mean",
        F.when(F.col("_sd") < 1e-9, F.lit(1.0)).otherwise(F.col("_sd")).alias("scale_std"),
    )


def scaled(series: DataFrame, spec: SeriesSpec, scaler: DataFrame, out: str = "z") -> DataFrame:
    """z = (v - mean) / std with the entity's scaler (X17); NULL for an entity without training rows, which stays."""
    s = series.join(scaler, spec.entity, "left")
    return s.withColumn(out, (F.col(spec.value) - F.col("scale_mean")) / F.col("scale_std"))


def lag_features(series: DataFrame, spec: SeriesSpec, lags: list[int], col: str | None = None, complete: bool = True) -> DataFrame:
    """One column per positional lag of ``col`` (W8 in column form, W9).

    Lags are taken over the whole ordered series before any split filter,
    so the first validation targets see the training tail. With
    ``complete`` only rows whose every lag exists are kept.
    """
    col = col or spec.value
    w = Window.partitionBy(spec.entity).orderBy(spec.ts)
    out = series.select("*", *[F.lag(col, k).over(w).alias(f"lag_{k}") for k in lags])
    if complete:
        cond = F.lit(True)
        for k in lags:
            cond = cond & F.col(f"lag_{k}").isNotNull()
        out = out.where(cond)
    return out


def sliding_windows(series: DataFrame, spec: SeriesSpec, seq_len: int, cols: list[str]) -> DataFrame:
    """The previous ``seq_len`` feature rows of each target as an array of structs.

    Rows with a shorter history are dropped, like the original window maker.
    """
    w = Window.partitionBy(spec.entity).orderBy(spec.ts).rowsBetween(-seq_len, -1)
    win = F.collect_list(F.struct(*[F.col(c) for c in cols])).over(w)
    return series.withColumn("window", win).where(F.size("window") == seq_len)
