"""One-step-ahead forecasters as DataFrame functions.

A forecaster maps a series table to ``(entity, ts, y_true, y_pred)`` for
every row, where ``y_pred`` only uses rows with ts <= t - step (strictly
past). Walk-forward evaluation is then a filter on the window, with no loop
over time steps.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions import time as tf
from . import chunks as ch
from .util import staged

Forecaster = Callable[..., DataFrame]


def _in_spans(series: DataFrame, spec: SeriesSpec, reach: int) -> tuple[DataFrame, Window]:
    """Rows and their window: the entity, or, if a series may be long, chunks of time that also hold the rows of the ``reach`` seconds before, with the last row before those (``_carry``).

    Adds ``_t`` (epoch seconds) and, for chunks, ``_own``. A look back in time sees the chunk's rows, or else the carried one.
    """
    rows = series.withColumn("_t", tf.epoch_seconds(series, spec.ts))
    if not spec.long:
        return rows, Window.partitionBy(spec.entity).orderBy("_t")
    steps = max(ch.CHUNK_STEPS, -(-reach // spec.step))
    length = steps * spec.step
    at = F.floor(F.col("_t") / length).cast("long")
    rows = staged(rows.withColumn("_at", at), "time-chunks")
    row = F.struct("_t", F.col(spec.value).alias("v"))
    # what a chunk hands to the next one, and to those after it
    spans = rows.groupBy(spec.entity, "_at").agg(F.max(F.when(F.col("_t") < (F.col("_at") + 1) * length - reach, row)).alias("_older"), F.max(row).alias("_last"))
    order = Window.partitionBy(spec.entity).orderBy("_at")
    far = F.last("_last", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, -2))
    near = F.last("_older", ignorenulls=True).over(order.rangeBetween(-1, -1))
    spans = spans.select(spec.entity, F.col("_at").alias("_span"), F.coalesce(near, far).alias("_carry"))
    reached = F.floor((F.col("_t") + reach) / length).cast("long")
    rows = rows.select("*", F.explode(F.sequence("_at", reached)).alias("_span")).withColumn("_own", F.col("_span") == F.col("_at"))
    return ch.with_spans(rows, spans, spec), Window.partitionBy(spec.entity, "_span").orderBy("_t")


def last_value_column(w: Window, spec: SeriesSpec):
    """Value of the last row with ts <= t - step (as-of backward lookup, J4)."""
    frame = w.rangeBetween(Window.unboundedPreceding, -spec.step)
    last = F.last(F.col(spec.value)).over(frame)
    return F.when(F.count(F.lit(1)).over(frame) > 0, last).otherwise(F.col("_carry.v")) if spec.long else last


def seasonal_column(w: Window, spec: SeriesSpec, period: int):
    """Value at exactly t - period*step; an absent key falls back to last value.

    Presence of the key decides: a present NULL is returned as NULL.
    """
    lag = period * spec.step
    frame = w.rangeBetween(-lag, -lag)
    hit = F.count(F.lit(1)).over(frame) > 0
    return F.when(hit, F.first(F.col(spec.value)).over(frame)).otherwise(last_value_column(w, spec))


def baseline_forecasts(series: DataFrame, spec: SeriesSpec, models: dict[str, int | None] | None = None) -> DataFrame:
    """Last-value and seasonal-naive forecasts for every row, long format.

    ``models`` maps a model name to a seasonal period in steps (``None`` =
    last value). All models share one window partitioning and ordering, so
    the plan has a single shuffle and a single sort; in a long series they share chunks of time that reach back as far as the longest period.
    """
    if models is None:
        models = {"naive_last": None, "naive_daily": spec.daily, "naive_weekly": spec.weekly}
    reach = spec.step * max(1, *(p or 1 for p in models.values()))
    rows, w = _in_spans(series.select(spec.entity, spec.ts, spec.value), spec, reach)
    cols = []
    for name, period in models.items():
        col = last_value_column(w, spec) if period is None else seasonal_column(w, spec, period)
        cols.append(col.cast("double").alias(name))
    wide = rows.select(spec.entity, spec.ts, F.col(spec.value).alias("y_true"), *["_own"] * spec.long, *cols)
    wide = wide.where("_own") if spec.long else wide
    return wide.unpivot([spec.entity, spec.ts, "y_true"], list(models), "model", "y_pred").select(
        "model", spec.entity, spec.ts, "y_true", "y_pred"
    )


def last_value(series: DataFrame, spec: SeriesSpec, name: str = "naive_last") -> DataFrame:
    return baseline_forecasts(series, spec, {name: None})


def seasonal_naive(series: DataFrame, spec: SeriesSpec, period: int, name: str | None = None) -> DataFrame:
    return baseline_forecasts(series, spec, {name or f"naive_period_{period}": period})


_PLUGINS: dict[str, Callable[..., DataFrame]] = {}


def register_forecaster(name: str, forecaster: Callable[..., DataFrame]) -> None:
    """Make ``forecaster(series, spec, **kw)`` available under ``name``.

    It returns (model, entity, ts, y_true, y_pred) with predictions from rows at
    or before t - step only, and is evaluated, ranked and compared like the built-in ones.
    """
    if name in {"naive_last", "naive_daily", "naive_weekly", "harmonic", "dhr", "learned_linear", "learned_tree"}:
        raise ValueError(f"{name!r} is built in")
    _PLUGINS[name] = forecaster


def registry(spec: SeriesSpec) -> dict[str, Forecaster]:
    """Model name → forecaster (G10), registered ones included. Unknown names raise ``ValueError``."""
    from . import harmonic, learned
    from .grouped import dhr_forecasts

    plugins = {k: (lambda s, f=f, **kw: f(s, spec, **kw)) for k, f in _PLUGINS.items()}
    return plugins | {
        "harmonic": lambda s, **kw: harmonic.harmonic_forecasts(s, spec, **kw),
        "naive_last": lambda s, **kw: last_value(s, spec, "naive_last"),
        "naive_daily": lambda s, **kw: seasonal_naive(s, spec, spec.daily, "naive_daily"),
        "naive_weekly": lambda s, **kw: seasonal_naive(s, spec, spec.weekly, "naive_weekly"),
        "dhr": lambda s, **kw: dhr_forecasts(s, spec, **kw),
        "learned_linear": lambda s, **kw: learned.linear_forecasts(s, spec, **kw),
        "learned_tree": lambda s, **kw: learned.tree_forecasts(s, spec, **kw),
    }


def get_forecaster(name: str, spec: SeriesSpec) -> Forecaster:
    models = registry(spec)
    if name not in models:
        raise ValueError(f"no forecaster is named {name!r}; there are {sorted(models)}")
    return models[name]
