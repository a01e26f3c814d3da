"""Series cut into chunks, so that one entity is the work of many tasks.

Rows first get their position in the series by a two-level count: row numbers inside chunks of time, which hold
a bounded number of steps, plus the number of rows in all chunks before, from a table with one row for each chunk. Windows
and lags then work on chunks of positions that carry the last ``halo`` rows of the chunks before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions import time as tf
from .util import staged

CHUNK_STEPS = 4096
POS, CHUNK, OWN = "_pos", "_chunk", "_own"


def span_of(series: DataFrame, spec: SeriesSpec, steps: int | None = None) -> Column:
    """The chunk of time that a row lies in; chunks have ``steps`` steps (CHUNK_STEPS if not given)."""
    return F.floor(tf.epoch_seconds(series, spec.ts) / (spec.step * (steps or CHUNK_STEPS))).cast("long")


def by_span(spec: SeriesSpec) -> Window:
    """The rows of a chunk of time, in order."""
    return Window.partitionBy(spec.entity, "_span").orderBy(spec.ts)


def _time_chunks(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add the chunk of time and the row number in it.

    Staged, because both the chunks' facts and the rows are read: the facts come from files that are already
    grouped, and their join needs no second shuffle of the rows where the facts are small.
    """
    rows = series.withColumn("_span", span_of(series, spec))
    return staged(rows.withColumn("_local", F.row_number().over(by_span(spec)).cast("long")), "spans")


def with_spans(rows: DataFrame, spans: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Join facts about chunks of time to their rows; null entities match as well."""
    facts = spans.withColumnsRenamed({spec.entity: "_e", "_span": "_s"})
    return rows.join(facts, rows[spec.entity].eqNullSafe(F.col("_e")) & (F.col("_span") == F.col("_s"))).drop("_e", "_s")


def placed(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``_pos``, the position from 0 by time in the entity's series."""
    rows = _time_chunks(series, spec)
    spans = rows.groupBy(spec.entity, "_span").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(spec.entity).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(spec.entity, "_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = with_spans(rows, spans, spec)
    return out.select(*[F.col(f"`{c}`") for c in series.columns], (F.col("_before") + F.col("_local") - 1).alias(POS))


def trended(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(entity, ts, _x, _pos, _n, _mean, _slope): rows with a value, their position, and the entity's size, mean and least-squares slope by position.

    Sums of the chunks are added up around each chunk's own start, then moved to the series' start.
    """
    x = F.col(spec.value).cast("double")
    rows = _time_chunks(series.where(x.isNotNull() & ~F.isnan(x)).select(spec.entity, spec.ts, x.alias("_x")), spec)
    local = F.col("_local") - 1
    spans = rows.groupBy(spec.entity, "_span").agg(F.count(F.lit(1)).alias("_m"), F.sum("_x").alias("_sx"), F.sum(local * F.col("_x")).alias("_slx"))
    entity = Window.partitionBy(spec.entity)
    before = entity.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    n, sx = F.sum("_m").over(entity), F.sum("_sx").over(entity)
    spans = spans.withColumn("_n", n).withColumn("_mean", sx / n)
    mid = (F.col("_n") - 1) / 2.0
    # sum of (pos - mid) * (x - mean); the mean's part of a chunk is its size times its middle
    about = F.col("_slx") + (F.col("_before") - mid) * F.col("_sx") - F.col("_mean") * F.col("_m") * (F.col("_before") + (F.col("_m") - 1) / 2.0 - mid)
    squares = F.col("_n") * (F.col("_n").cast("double") * F.col("_n") - 1) / 12.0
    spans = spans.withColumn("_slope", F.try_divide(F.sum(about).over(entity), squares))
    spans = spans.select(spec.entity, "_span", "_before", "_n", "_mean", "_slope")
    out = with_spans(rows, spans, spec)
    return out.select(spec.entity, spec.ts, "_x", (F.col("_before") + local).alias(POS), "_n", "_mean", "_slope")


def with_halo(rows: DataFrame, halo: int | Column, size: int | Column | None = None) -> DataFrame:
    """Rows with a ``_pos`` in chunks of ``size`` positions (CHUNK_STEPS if not given) that also hold the ``halo`` positions before; ``halo`` is at most ``size``.

    Adds ``_chunk`` and ``_own`` (false for the rows of the chunk before).
    """
    size = CHUNK_STEPS if size is None else size
    size, halo = (F.lit(v) if isinstance(v, int) else v for v in (size, halo))
    at = F.floor(F.col(POS) / size).cast("long")
    next_too = (F.col(POS) - at * size) >= size - halo
    chunks = F.when(next_too, F.array(at, at + 1)).otherwise(F.array(at))
    out = rows.select("*", F.explode(chunks).alias(CHUNK))
    return out.withColumn(OWN, F.col(CHUNK) == at)


def by_chunk(spec: SeriesSpec) -> Window:
    """The rows of a chunk of positions, in order; of the entity if its series is not long."""
    return Window.partitionBy(spec.entity, CHUNK).orderBy(POS) if spec.long else Window.partitionBy(spec.entity).orderBy(spec.ts)


def halo_windows(series: DataFrame, spec: SeriesSpec, halo: int, unit: int = 1) -> DataFrame:
    """A series' rows for windows that look back at most ``halo`` rows: as they are, or, if the series may be long, in chunks of positions that carry ``halo`` rows more and hold whole multiples of ``unit`` rows."""
    if not spec.long:
        return series
    size = -(-max(CHUNK_STEPS, halo) // unit) * unit
    return with_halo(placed(series, spec), halo, size)


def own_rows(rows: DataFrame, spec: SeriesSpec, columns: list[str], *more: Column) -> DataFrame:
    """The rows that are not a halo's, without the helper columns."""
    return (rows.where(OWN) if spec.long else rows).select(*[F.col(f"`{c}`") for c in columns], *more)


def chunk_arrays(rows: DataFrame, spec: SeriesSpec, value: Column, keep: list[str], halo: int | Column, size: int | Column) -> DataFrame:
    """One row for each chunk: (entity, _chunk, *keep, first, halo, xs): its values with the halo's in order, the position of the first, and how many are the halo's.

    A chunk without a row of its own (the halo of the last one) is left out.
    """
    items = with_halo(rows.select(spec.entity, POS, *keep, value.alias("_v")), halo, size)
    out = items.groupBy(spec.entity, CHUNK, *keep).agg(
        F.sort_array(F.collect_list(F.struct(POS, "_v"))).alias("_items"),
        F.sum((~F.col(OWN)).cast("int")).alias("halo"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return out.where("_rows > halo").select(spec.entity, CHUNK, *keep, F.col("_items")[0][POS].alias("first"), "halo", F.transform("_items", lambda i: i["_v"]).alias("xs"))
