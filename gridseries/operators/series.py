"""Series algebra over long (entity, ts, value) tables.

S8 S9 F2-F5 A1 A2 J8 T4 W5 plus regularise / missing bins.
Every window here is ``partitionBy(entity)``; after binning an entity holds
at most span / step rows, whatever the raw volume was.
"""

from __future__ import annotations

from datetime import datetime
from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec, Split
from ..functions import time as tf
from . import chunks as ch
from .util import staged

GRID_CHUNK = 1024  # steps per generated block of the calendar grid


def ts_literal(df: DataFrame, name: str, value: datetime, tz: str) -> Column:
    """A wall-clock bound comparable with column ``name``.

    For ``timestamp_ntz`` columns the bound is used as is; for instants a
    naive bound is localised to ``tz`` and an aware bound converted.
    """
    if tf.is_ntz(df, name):
        v = value.replace(tzinfo=None) if value.tzinfo is not None else value
        # built from its fields: a datetime literal would pass through the
        # Python process zone and the session zone on its way to wall-clock time
        return F.make_timestamp_ntz(
            F.lit(v.year), F.lit(v.month), F.lit(v.day), F.lit(v.hour), F.lit(v.minute),
            F.lit(v.second + v.microsecond / 1e6).cast("decimal(16,6)"),
        )
    if value.tzinfo is not None:
        return F.lit(value).cast("timestamp")
    return F.make_timestamp(
        F.lit(value.year), F.lit(value.month), F.lit(value.day),
        F.lit(value.hour), F.lit(value.minute), F.lit(value.second + value.microsecond / 1e6).cast("decimal(16,6)"),
        F.lit(tz),
    )


def binned(
    df: DataFrame,
    spec: SeriesSpec,
    entity: str,
    ts: str,
    value: str,
    agg: str = "sum",
) -> DataFrame:
    """Aggregate raw records into (entity, bin) rows (A1).

    Rows with a NULL measure are dropped before aggregation (F1), so a bin
    with only NULLs disappears (a gap, not a zero).
    """
    fn = {"sum": F.sum, "avg": F.avg, "count": F.count}[agg]
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(entity).alias(spec.entity), tf.bin_start(df, ts, spec.step).alias(spec.ts))
        .agg(fn(F.col(value)).cast("double").alias(spec.value))
    )


def area_series(
    df: DataFrame,
    spec: SeriesSpec,
    entity_value,
    start: datetime | None = None,
    end: datetime | None = None,
    sort: bool = True,
) -> DataFrame:
    """One entity's series, optional inclusive [start, end].

    Duplicated timestamps are kept, as in the original loader.
    """
    cond = F.col(spec.entity) == F.lit(entity_value)
    if start is not None:
        cond = cond & (F.col(spec.ts) >= ts_literal(df, spec.ts, start, spec.tz))
    if end is not None:
        cond = cond & (F.col(spec.ts) <= ts_literal(df, spec.ts, end, spec.tz))
    out = df.where(cond).select(spec.entity, spec.ts, spec.value)
    return out.orderBy(spec.ts) if sort else out


def areas_wide(
    df: DataFrame,
    spec: SeriesSpec,
    ids: Iterable,
    start: datetime | None = None,
    end: datetime | None = None,
    prefix: str = "area_",
) -> DataFrame:
    """One column per entity, duplicate (ts, entity) averaged.

    The id list is given, so ``pivot`` needs no extra distinct job. Ids
    absent from the data give all-NULL columns (the original dropped them;
    finding them would take an extra job over the data).
    """
    ids = list(ids)
    cond = F.col(spec.entity).isin(ids)
    if start is not None:
        cond = cond & (F.col(spec.ts) >= ts_literal(df, spec.ts, start, spec.tz))
    if end is not None:
        cond = cond & (F.col(spec.ts) <= ts_literal(df, spec.ts, end, spec.tz))
    wide = df.where(cond).groupBy(spec.ts).pivot(spec.entity, ids).agg(F.avg(spec.value))
    return wide.select(spec.ts, *[F.col(f"`{i}`").alias(f"{prefix}{i}") for i in ids])


def area_totals(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Total per entity over the whole table (A2)."""
    return df.groupBy(spec.entity).agg(F.sum(spec.value).cast("double").alias("total"))


def top_k(totals: DataFrame, spec: SeriesSpec, k: int = 1) -> DataFrame:
    """Entities with the largest totals; ties go to the smallest id (T4)."""
    # ranks only the k rows left after the limit (TakeOrderedAndProject)
    w = Window.orderBy(F.desc("total"), F.asc(spec.entity))
    return (
        totals.orderBy(F.desc("total"), F.asc(spec.entity))
        .limit(k)
        .withColumn("rank", F.row_number().over(w))
    )


def resolve_areas(spark, spec_text: str, totals: DataFrame, spec: SeriesSpec, top_label: str = "top({id})") -> DataFrame:
    """Resolve a list such as ``"top, 4159, 4556"`` into (position, label, id).

    ``top`` is the argmax of ``totals`` (ties → smallest id); blanks are
    trimmed and empty tokens skipped. The top-1 id is a one-row aggregate
    attached as a scalar subquery, never a join.
    """
    tokens = (
        spark.createDataFrame([(spec_text,)], "spec string")
        .select(F.posexplode(F.split("spec", ",")).alias("position", "token"))
        .select("position", F.trim("token").alias("token"))
        .where(F.col("token") != "")
        .withColumn("is_top", F.lower("token") == "top")
    )
    from .util import attach_scalars

    best = totals.agg(F.max_by(F.col(spec.entity), F.struct(F.col("total"), -F.col(spec.entity))).alias("top_id"))
    joined = attach_scalars(tokens, best)
    ident = F.when(F.col("is_top"), F.col("top_id")).otherwise(F.col("token").cast("bigint"))
    label = F.when(
        F.col("is_top"),
        F.replace(F.lit(top_label), F.lit("{id}"), F.col("top_id").cast("string")),
    ).otherwise(F.col("token"))
    resolved = joined.select("position", label.alias("label"), ident.alias(spec.entity))
    # a repeated label keeps its first position, like re-assigning a dict key
    return resolved.groupBy("label", spec.entity).agg(F.min("position").alias("position"))


def split_label(df: DataFrame, spec: SeriesSpec, split: Split) -> Column:
    """'train' / 'validation' / 'test' / NULL by inclusive bounds (F5), one pass."""
    ts = F.col(spec.ts)

    def between(a, b):
        return ts.between(ts_literal(df, spec.ts, a, spec.tz), ts_literal(df, spec.ts, b, spec.tz))

    return (
        F.when(between(split.train_start, split.train_end), F.lit("train"))
        .when(between(split.val_start, split.val_end), F.lit("validation"))
        .when(between(split.test_start, split.test_end), F.lit("test"))
    )


def with_split(df: DataFrame, spec: SeriesSpec, split: Split, name: str = "split") -> DataFrame:
    return df.withColumn(name, split_label(df, spec, split))


def calendar_grid(df: DataFrame, spec: SeriesSpec, bounds: DataFrame | None = None) -> DataFrame:
    """Every step between each entity's first and last bin.

    ``bounds`` may give explicit (entity, lo, hi) instead of the observed span.
    """
    if bounds is None:
        bounds = df.groupBy(spec.entity).agg(F.min(spec.ts).alias("lo"), F.max(spec.ts).alias("hi"))
    step = F.make_dt_interval(secs=F.lit(spec.step).cast("decimal(18,6)"))
    chunk = F.make_dt_interval(secs=F.lit(spec.step * GRID_CHUNK).cast("decimal(18,6)"))
    last = F.make_dt_interval(secs=F.lit(spec.step * (GRID_CHUNK - 1)).cast("decimal(18,6)"))
    # two-level explode: no row ever holds more than GRID_CHUNK timestamps
    starts = bounds.select(spec.entity, "hi", F.explode(F.sequence("lo", "hi", chunk)).alias("_c"))
    return starts.select(
        spec.entity, F.explode(F.sequence("_c", F.least(F.col("_c") + last, F.col("hi")), step)).alias(spec.ts)
    )


def regularise(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Left-join each series onto its full step grid; gaps become NULL values."""
    grid = calendar_grid(df, spec)
    return grid.join(df.select(spec.entity, spec.ts, spec.value), [spec.entity, spec.ts], "left")


def missing_bins(df: DataFrame, spec: SeriesSpec, bounds: DataFrame | None = None) -> DataFrame:
    """Grid steps with no row (J1 generalised to any step): grid left_anti present."""
    grid = calendar_grid(df, spec, bounds)
    return grid.join(df.select(spec.entity, spec.ts), [spec.entity, spec.ts], "left_anti")


def interpolate(df: DataFrame, spec: SeriesSpec, out: str | None = None) -> DataFrame:
    """Positional linear interpolation of NULL values, edges filled.

    Position is the row number within the entity (not time), like pandas'
    default ``interpolate(limit_direction="both")``. The neighbour before is a
    running ``last`` by rising time, the one after a running ``last`` by falling
    time. In a long series both run inside chunks of time, and rows at their edges get what the
    chunks before and after hold, from a table with one row for each chunk.
    """
    out = out or spec.value
    v = F.col(spec.value)
    keys = [spec.entity, *["_span"] * spec.long]
    rows = df.withColumn("_span", ch.span_of(df, spec)) if spec.long else df
    rising = Window.partitionBy(*keys).orderBy(spec.ts)
    falling = Window.partitionBy(*keys).orderBy(F.col("_r").desc())
    running = (Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_r", F.row_number().over(rising).cast("long"))
    known = F.when(v.isNotNull(), F.struct(F.col("_r").alias("r"), v.cast("double").alias("v")))
    rows = rows.withColumn("_p", F.last(known, ignorenulls=True).over(rising.rowsBetween(*running)))
    rows = rows.withColumn("_n", F.last(known, ignorenulls=True).over(falling.rowsBetween(*running)))
    if spec.long:
        rows = _across_spans(staged(rows, "interpolate"), spec, known)
    at = F.col("_r")
    lin = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (at - F.col("_p.r")) / (F.col("_n.r") - F.col("_p.r"))
    filled = F.coalesce(
        v,
        F.when(F.col("_p").isNotNull() & F.col("_n").isNotNull(), lin),
        F.col("_n.v"),
        F.col("_p.v"),
    ).cast("double")
    names = df.columns if out in df.columns else [*df.columns, out]
    return rows.select(*[filled.alias(out) if c == out else F.col(f"`{c}`") for c in names])


def _across_spans(rows: DataFrame, spec: SeriesSpec, known: Column) -> DataFrame:
    """Rows of chunks of time with the neighbours ``_p`` and ``_n`` and the row number ``_r`` of the whole series."""
    spans = rows.groupBy(spec.entity, "_span").agg(F.count(F.lit(1)).alias("_m"), F.min(known).alias("_first"), F.max(known).alias("_last"))
    order = Window.partitionBy(spec.entity).orderBy("_span")
    spans = spans.withColumn("_o", F.coalesce(F.sum("_m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = lambda c: F.when(F.col(c).isNotNull(), F.struct((F.col("_o") + F.col(c)["r"]).alias("r"), F.col(c)["v"].alias("v")))
    spans = spans.select(
        spec.entity,
        "_span",
        "_o",
        F.last(placed("_last"), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first(placed("_first"), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    rows = ch.with_spans(rows, spans, spec)
    rows = rows.withColumn("_p", F.coalesce(placed("_p"), "_before")).withColumn("_n", F.coalesce(placed("_n"), "_after"))
    return rows.withColumn("_r", F.col("_o") + F.col("_r"))
