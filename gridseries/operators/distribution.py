"""City-level distribution of per-entity totals and the spatial grid.

All inputs are the per-entity totals table ``(entity, total)``: one row per
cell, never the raw rows, so these stay small however large the store is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import kurtosis_unbiased, log10_positive, skew_unbiased
from .util import attach_scalars, staged

# exp(-u*u/2) is exactly 0.0 in double precision for u >= 38.6, so kernel
# terms further than this many bandwidths contribute nothing.
KDE_SUPPORT = 39.0
#: Bins of a bandwidth, and terms of a bin's expansion.
KDE_BINS = 16
KDE_TERMS = 7


def exact_percentiles(df: DataFrame, value: str, levels: dict[str, float]) -> DataFrame:
    """One row of exact percentiles with linear interpolation (A6), by a distributed sort.

    Distinct values with their counts are range-sorted and staged with their
    task number; running counts within a task plus the counts of the tasks
    before give each value its ranks, and a percentile is the first
    value whose rank reaches it. No buffer holds the values: the largest piece of state
    is one task's share of the sort.
    """
    x = F.col(value).cast("double")
    counted = df.where(x.isNotNull()).groupBy(x.alias("x")).agg(F.count(F.lit(1)).alias("n"))
    placed = counted.repartitionByRange("x").withColumn("task", F.spark_partition_id())
    placed = staged(placed, "percentiles")
    tasks = placed.groupBy("task").agg(F.sum("n").alias("n"))
    before = tasks.selectExpr("task", "sum(n) OVER (ORDER BY task) - n AS before")  # a row for each task
    total = placed.agg(F.sum("n").alias("total"))
    own = F.sum("n").over(Window.partitionBy("task").orderBy("x"))
    ranked = attach_scalars(placed.withColumn("own", own).join(before, "task"), total)
    upto = F.col("own") + F.col("before")

    def at(rank):
        return F.min(F.when(upto > rank, F.col("x")))

    out = []
    for name, p in levels.items():
        pos = (F.col("total") - 1) * F.lit(p)
        lo, hi = at(F.floor(pos)), at(F.ceil(pos))
        out.append((lo + (hi - lo) * F.max(pos - F.floor(pos))).alias(name))
    return ranked.agg(*out)


def city_stats(totals: DataFrame, value: str = "total", exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """n, n_positive, mean, median, pop. std, min, max, bias-corrected skew and
    excess kurtosis of the positive totals, percentiles 1/5/95/99 (A4-A6).

    Percentiles are exact with linear interpolation (numpy's default), by a
    distributed sort; ``exact=False`` takes one pass with the bounded-error sketch.
    """
    x = F.col(value)
    pos = F.when(x > 0, x)
    levels = {"median": 0.5, "p1": 0.01, "p5": 0.05, "p95": 0.95, "p99": 0.99}
    approx = [] if exact else [F.percentile_approx(x, p, accuracy).cast("double").alias(n) for n, p in levels.items()]
    totals = staged(totals.select(value), "totals") if exact else totals
    stats = totals.agg(
        F.count(x).alias("n_areas"),
        F.count_if(x > 0).alias("n_positive"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        skew_unbiased(pos).alias("skew"),
        kurtosis_unbiased(pos).alias("kurtosis"),
        *approx,
    )
    if exact:
        stats = attach_scalars(stats, exact_percentiles(totals, value, levels))
    return stats.select("n_areas", "n_positive", "mean", "median", "std", "min", "max", "skew", "kurtosis", "p1", "p5", "p95", "p99")


def histogram(totals: DataFrame, bins: int = 80, value: str = "total") -> DataFrame:
    """Equal-width histogram of positive totals, last bin closed.

    Output has every bin, empty ones with count 0: (bin, lo, hi, count).
    """
    spark = totals.sparkSession
    # one row per entity, read by the bounds subquery and the main plan: computed once
    pos = staged(totals.where(F.col(value) > 0).select(F.col(value).alias("x")), "positive-totals")
    bounds = pos.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = F.col("hi") - F.col("lo")
    idx = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / width)), F.lit(bins - 1))).otherwise(0)
    counts = attach_scalars(pos, bounds).select(idx.cast("bigint").alias("bin")).groupBy("bin").count()
    grid = attach_scalars(spark.range(bins).withColumnRenamed("id", "bin"), bounds)
    edges = grid.select(
        "bin",
        (F.col("lo") + F.col("bin") * width / bins).alias("lo"),
        (F.col("lo") + (F.col("bin") + 1) * width / bins).alias("hi"),
    )
    return edges.join(counts, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


def _hermite_sum(terms: list[Column], u: Column) -> Column:
    """Sum of terms[k] * He_k(u), from the last to the first (He: probabilists' Hermite polynomials)."""
    after, after_next = F.lit(0.0), F.lit(0.0)
    for k in range(len(terms) - 1, -1, -1):
        after, after_next = terms[k] + u * after - (k + 1) * after_next, after
    return after


def kde(totals: DataFrame, points: int = 400, value: str = "total") -> DataFrame:
    """Gaussian KDE of log10 of the positive totals on an even grid.

    Scott bandwidth h = sample std * n^(-1/5). Observations are first reduced to
    bins of h / KDE_BINS, each with the sums of the powers of its members' distances from
    its centre; a bin's kernel at distance u is then
    exp(-u^2/2) * sum of power sum k / k! * He_k(u). What KDE_TERMS terms leave out is at most
    (1 / 2 KDE_BINS)^KDE_TERMS / sqrt(KDE_TERMS!) of a kernel's peak, 4e-13 here. A bin
    adds to the grid points within ``KDE_SUPPORT`` bandwidths, beyond which the kernel is zero
    in double precision. So one partial aggregate reads the observations, and the rows that
    are emitted follow the occupied bins (about 16 for each bandwidth of the range), not n.
    """
    spark = totals.sparkSession
    logs = totals.select(log10_positive(F.col(value)).alias("x")).where(F.col("x").isNotNull())
    logs = staged(logs, "log-totals")  # read by the bandwidth subquery and the main plan
    st = logs.agg(
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
        F.count("x").alias("n"),
        (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("h"),
    )
    step = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / (points - 1)).otherwise(F.lit(1.0))
    st = st.withColumn("dx", step)
    z = F.try_divide(F.col("x") - F.col("lo"), F.col("h"))
    placed = attach_scalars(logs, st).where(F.col("h") > 0).select(z.alias("z"), F.floor(z * KDE_BINS).alias("bin"))
    off = F.col("z") - F.col("centre")
    powers = [F.count(F.lit(1)).cast("double"), *[F.sum(F.pow(off, F.lit(float(k)))) for k in range(1, KDE_TERMS)]]
    bins = placed.withColumn("centre", (F.col("bin") + 0.5) / KDE_BINS).groupBy("bin", "centre")
    bins = attach_scalars(bins.agg(*[(p / math.factorial(k)).alias(f"t{k}") for k, p in enumerate(powers)]), st)
    per_h = F.try_divide(F.col("dx"), F.col("h"))
    j_lo = F.greatest(F.lit(0), F.ceil((F.col("centre") - KDE_SUPPORT) / per_h))
    j_hi = F.least(F.lit(points - 1), F.floor((F.col("centre") + KDE_SUPPORT) / per_h))
    near = bins.where(j_lo <= j_hi).withColumn("j", F.explode(F.sequence(j_lo.cast("int"), j_hi.cast("int"))))
    near = near.withColumn("u", F.col("j") * per_h - F.col("centre"))
    kernel = F.exp(-0.5 * F.col("u") * F.col("u")) * _hermite_sum([F.col(f"t{k}") for k in range(KDE_TERMS)], F.col("u"))
    sums = near.groupBy("j").agg(F.sum(kernel).alias("_k"))
    grid = attach_scalars(spark.range(points).select(F.col("id").cast("int").alias("j")), st)
    norm = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    return grid.join(sums, "j", "left").select(
        F.col("j").alias("point"),
        (F.col("lo") + F.col("j") * F.col("dx")).alias("log10_total"),
        # a zero bandwidth (all totals equal) has no density: NULL, not an error
        F.try_divide(F.coalesce(F.col("_k"), F.lit(0.0)), F.when(norm > 0, norm)).alias("density"),
    )


def square_side(largest: Column) -> Column:
    """Side of the smallest square grid that holds ids up to ``largest`` (1-based), exact for any bigint."""
    below = F.greatest(largest.cast("bigint"), F.lit(1)) - 1
    root = F.floor(F.sqrt(below.cast("double")))
    # the double root of a large id can be off by one either way
    return (F.when(root * root > below, root - 1).when((root + 1) * (root + 1) <= below, root + 1).otherwise(root) + 1).cast("bigint")


def occupied_cells(totals: DataFrame, entity: str, side: int | None = None, value: str = "total") -> DataFrame:
    """(entity, row, col, total, log10_total) of the cells that hold something.

    1-based ids lie row by row from the bottom-left of a ``side`` x ``side`` grid; without a
    side the smallest that holds every id, found by a subquery. One row for each entity,
    whatever the ids are; empty cells are implied. Rows without an id have no place; an id
    below 1 or beyond the side fails rather than be lost.
    """
    id_ = F.col(entity).cast("bigint")
    t = totals.where(id_.isNotNull()).select(id_.alias(entity), F.col(value).alias("total"))
    if side is None:
        t = staged(t, "cell-totals")  # read for the side and for the cells
        t = attach_scalars(t, t.agg(square_side(F.max(entity)).alias("_side")))
    else:
        t = t.withColumn("_side", F.lit(side).cast("bigint"))
    outside = F.expr(f"`{entity}` < 1 OR (`{entity}` - 1) div _side >= _side")  # whole division: a double loses digits of large ids
    checked = F.when(outside, F.raise_error(F.concat(F.lit("cell id outside the grid: "), F.col(entity).cast("string"))).cast("bigint"))
    t = t.withColumn(entity, checked.otherwise(F.col(entity)))
    return t.select(
        entity,
        F.expr(f"(`{entity}` - 1) div _side").alias("row"),
        F.pmod(F.col(entity) - 1, F.col("_side")).alias("col"),
        "total",
        log10_positive(F.col("total")).alias("log10_total"),
    )


def grid_tiles(cells: DataFrame, size: int = 32) -> DataFrame:
    """Index of a sparse grid: (tile_row, tile_col, n_cells, n_nonzero, total, max_total) of each tile that holds a cell."""
    place = [F.expr(f"`{c}` div {int(size)}").alias(f"tile_{c}") for c in ("row", "col")]
    return cells.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(F.col("total") > 0).alias("n_nonzero"),
        F.sum("total").alias("total"),
        F.max("total").alias("max_total"),
    )


def grid_side(totals: DataFrame, entity: str) -> int:
    """Side of the smallest square grid that holds every id (1-based); one scalar job."""
    return totals.agg(F.coalesce(square_side(F.max(F.col(entity).cast("bigint"))), F.lit(1))).first()[0]


def spatial_grid(
    totals: DataFrame, spark: SparkSession, entity: str, side: int | None = None, value: str = "total", window: tuple[int, int, int, int] | None = None
) -> DataFrame:
    """Dense view of the occupied cells: every cell appears, empty ones with NULL.

    ``window`` (first row, first column, rows, columns) views a part: the rows made follow
    the window's area, so a grid of sparse large ids is looked at piece by piece, with
    :func:`grid_tiles` to tell where. Without one, the whole ``side`` x ``side`` grid.
    """
    side = grid_side(totals, entity) if side is None else side
    row, col, rows, cols = window or (0, 0, side, side)
    rows, cols = min(rows, side - row), min(cols, side - col)
    at = spark.range(max(0, rows) * max(0, cols)).selectExpr(f"CAST({row} + id div {cols} AS BIGINT) AS r", f"CAST({col} + id % {cols} AS BIGINT) AS c")
    cells = at.select((F.col("r") * side + F.col("c") + 1).alias(entity), F.col("r").cast("int").alias("row"), F.col("c").cast("int").alias("col"))
    held = occupied_cells(totals, entity, side, value)
    if window:  # the check of the ids stays below: it is part of the columns read here
        held = held.where(F.col("row").between(row, row + rows - 1) & F.col("col").between(col, col + cols - 1))
    return cells.join(held.drop("row", "col"), entity, "left").select(entity, "row", "col", "total", "log10_total")


def spatial_stats(totals: DataFrame, entity: str, value: str = "total") -> DataFrame:
    """Top entity (ties → smallest id), its total, non-zero grid cells (A17); empty cells need not exist to be left out."""
    return totals.agg(
        F.max_by(F.col(entity), F.struct(F.col(value), -F.col(entity).cast("bigint"))).alias("top_area"),
        F.max(value).alias("top_value"),
        F.count_if(F.col(value) > 0).alias("n_nonzero"),
    )
