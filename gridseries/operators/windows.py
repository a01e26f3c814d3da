"""Per-entity window operators.

Windows are ``partitionBy(entity)``: a binned series has at most span / step rows. Where the spec says that a series may
be long, it is cut into chunks of positions that carry as many rows of the chunk before as a window looks back
(:mod:`.chunks`), windows are ``partitionBy(entity, chunk)``, and one series is the work of many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions import time as tf
from . import chunks as ch


def trailing_stats(series: DataFrame, spec: SeriesSpec, width: int) -> DataFrame:
    """Add the count, sum and squared deviations (_n, _sum, _m2) of the last ``width`` rows, in time linear in the rows.

    Rows are taken in blocks of ``width``, so a window is the end of
    one block and the start of the next. Both are running aggregates of their
    block, by falling and by rising time; the end's is found ``width - 1`` rows
    back. Nothing is subtracted, so a window of equal values has no rounding residue.
    Adds ``_rn`` (row number) too.
    """
    v = F.col(spec.value)
    rows = ch.halo_windows(series, spec, width - 1, width)
    if not spec.long:
        rows = rows.withColumn(ch.POS, F.row_number().over(ch.by_chunk(spec)).cast("long") - 1)
    keys = [spec.entity, *[ch.CHUNK] * spec.long]
    rows = rows.withColumn("_block", F.floor(F.col(ch.POS) / width))
    block = Window.partitionBy(*keys, "_block")

    def stats(order: Column) -> Column:
        frame = block.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        n = F.count(v).over(frame)
        return F.struct(n.alias("n"), F.coalesce(F.sum(v).over(frame), F.lit(0.0)).alias("s"), F.coalesce(F.var_pop(v).over(frame) * n, F.lit(0.0)).alias("m2"))

    rows = rows.withColumn("_end", stats(F.col(ch.POS).desc())).withColumn("_start", stats(F.col(ch.POS).asc()))
    # ordered like the block's rows, so that no sort is needed
    before = F.lag("_end", width - 1).over(Window.partitionBy(*keys).orderBy("_block", ch.POS))
    whole = (F.col(ch.POS) + 1) % width == 0  # the window is this row's block
    rows = rows.withColumn("_end", F.when(~whole, before)).withColumn("_rn", F.col(ch.POS) + 1)
    a, b = F.col("_end"), F.col("_start")
    gap = a["s"] / a["n"] - b["s"] / b["n"]
    both = (a["n"] > 0) & (b["n"] > 0)
    m2 = a["m2"] + b["m2"] + F.when(both, gap * gap * a["n"] * b["n"] / (a["n"] + b["n"])).otherwise(0.0)
    return ch.own_rows(
        rows,
        spec,
        series.columns,
        F.col("_rn"),
        F.when(a.isNull(), b["n"]).otherwise(a["n"] + b["n"]).alias("_n"),
        F.when(a.isNull(), b["s"]).otherwise(a["s"] + b["s"]).alias("_sum"),
        F.when(a.isNull(), b["m2"]).otherwise(m2).alias("_m2"),
    )


def rolling_stats(series: DataFrame, spec: SeriesSpec, window: int) -> DataFrame:
    """Rolling mean and sample std over ``window`` rows; NULL until full."""
    full = F.col("_n") == window
    return trailing_stats(series, spec, window).select(
        *[F.col(f"`{c}`") for c in series.columns],
        F.when(full, F.col("_sum") / window).alias("rolling_mean"),
        (F.when(full & (F.lit(window) > 1), F.sqrt(F.col("_m2") / max(1, window - 1)))).alias("rolling_std"),
    )


def looking_back(series: DataFrame, spec: SeriesSpec, halo: int, **columns: Column) -> DataFrame:
    """Add columns computed by windows that look back at most ``halo`` rows."""
    rows = ch.halo_windows(series, spec, halo)
    kept = [c for c in series.columns if c not in columns]
    return ch.own_rows(rows.withColumns(columns), spec, kept + list(columns))


def moving_average(series: DataFrame, spec: SeriesSpec, window: int = 6, out: str = "moving_avg") -> DataFrame:
    """Trailing mean over up to ``window`` rows, min_periods = 1."""
    frame = ch.by_chunk(spec).rowsBetween(-(window - 1), 0)
    return looking_back(series, spec, window - 1, **{out: F.avg(F.col(spec.value)).over(frame)})


def difference(series: DataFrame, spec: SeriesSpec, lag: int = 1, out: str = "diff", dropna: bool = True) -> DataFrame:
    """v_t - v_{t-lag} by position; the first ``lag`` rows are dropped."""
    d = looking_back(series, spec, lag, **{out: F.col(spec.value) - F.lag(spec.value, lag).over(ch.by_chunk(spec))})
    return d.where(F.col(out).isNotNull()) if dropna else d


def differences(series: DataFrame, spec: SeriesSpec, lags: list[int], out: str = "diff") -> DataFrame:
    """Differences at several lags in long form (.., lag, diff), from one window pass."""
    cols = {f"_d{k}": F.col(spec.value) - F.lag(spec.value, k).over(ch.by_chunk(spec)) for k in lags}
    rows = looking_back(series.select(spec.entity, spec.ts, spec.value), spec, max(lags), **cols)
    long = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_d{k}").alias(out)) for k in lags]))
    return rows.select(spec.entity, spec.ts, long.alias("_d")).select(spec.entity, spec.ts, "_d.lag", f"_d.{out}").where(F.col(out).isNotNull())


def shift(series: DataFrame, spec: SeriesSpec, lag: int, out: str = "shifted") -> DataFrame:
    """Value ``lag`` rows earlier."""
    return looking_back(series, spec, lag, **{out: F.lag(spec.value, lag).over(ch.by_chunk(spec))})


def preview(series: DataFrame, spec: SeriesSpec, window: int, session_tz: str = "UTC") -> DataFrame:
    """Series with trailing moving average and weekend flag in local time."""
    out = moving_average(series, spec, window)
    wall = tf.wallclock(out, spec.ts, spec.tz, session_tz)
    return out.withColumn("is_weekend", tf.weekday_mon0(wall) >= 5)


def runs(
    flagged: DataFrame,
    spec: SeriesSpec,
    flag: str,
    min_length: int,
    measure: str | None = None,
) -> DataFrame:
    """Runs of consecutive flagged rows of at least ``min_length``.

    Gaps and islands: row_number within the entity minus row_number within
    (entity, flag) is constant along a run. A run still open at the series
    end counts. In a long series runs are found in chunks of positions, and those that touch a
    chunk's edge, two at most in each, are joined with their neighbours. Output: (entity, start, end, length[, mean_<measure>]).
    """
    if not spec.long:
        order = ch.by_chunk(spec)
        rows = flagged.withColumn("_rn", F.row_number().over(order)).where(F.col(flag))
        rows = rows.withColumn("_island", F.col("_rn") - F.row_number().over(order))
        aggs = [F.min(spec.ts).alias("start"), F.max(spec.ts).alias("end"), F.count(F.lit(1)).alias("length")]
        aggs += [F.avg(measure).alias(f"mean_{measure}")] if measure is not None else []
        return rows.groupBy(spec.entity, "_island").agg(*aggs).where(F.col("length") >= min_length).drop("_island")
    size = ch.CHUNK_STEPS
    rows = ch.placed(flagged, spec).where(F.col(flag)).withColumn(ch.CHUNK, F.floor(F.col(ch.POS) / size))
    rows = rows.withColumn("_island", F.col(ch.POS) - F.row_number().over(ch.by_chunk(spec)))
    aggs = [F.min(spec.ts).alias("start"), F.max(spec.ts).alias("end"), F.count(F.lit(1)).alias("length"), F.min(ch.POS).alias("_a"), F.max(ch.POS).alias("_b")]
    if measure is not None:
        aggs += [F.sum(measure).alias("_sum"), F.count(measure).alias("_n")]
    parts = rows.groupBy(spec.entity, ch.CHUNK, "_island").agg(*aggs).drop(ch.CHUNK, "_island")
    at_edge = (F.col("_a") % size == 0) | (F.col("_b") % size == size - 1)
    order = Window.partitionBy(spec.entity).orderBy("_a")
    begins = F.coalesce(F.lag("_b").over(order) + 1 != F.col("_a"), F.lit(True)).cast("int")
    edges = parts.where(at_edge).withColumn("_new", begins).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sums = [F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")] if measure is not None else []
    joined = edges.groupBy(spec.entity, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("length").alias("length"), *sums).drop("_run")
    out = parts.where(~at_edge).drop("_a", "_b").unionByName(joined).where(F.col("length") >= min_length)
    mean = [F.try_divide(F.col("_sum"), F.col("_n")).alias(f"mean_{measure}")] if measure is not None else []
    return out.select(spec.entity, "start", "end", "length", *mean)


def flag_column(cond: Column) -> Column:
    """NULL comparisons (NaN in pandas) never flag."""
    return F.coalesce(cond, F.lit(False))
