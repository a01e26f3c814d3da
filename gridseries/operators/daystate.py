"""Mergeable state of each day: totals, moments and quantile sketches.

A day's rows are reduced once, to one row for each entity (``totals``) and one row
for the day (``state``: counts, central moments, a KLL sketch of the entities'
totals of that day). Questions over any range of days then read these small tables, and a
late or repeated day replaces its own folder only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions import time as tf
from .util import attach_scalars, staged

#: Size of a KLL sketch: a quantile's rank is off by about 2.3 / k^0.9 at 99 % confidence.
SKETCH_K = 800
RANK_ERROR = 0.01
LEVELS = {"median": 0.5, "p1": 0.01, "p5": 0.05, "p95": 0.95, "p99": 0.99}
STATE_SCHEMA = (
    "n long, mean double, m2 double, min double, max double, "
    "pos_n long, pos_mean double, pos_m2 double, pos_m3 double, pos_m4 double, sketch binary, day date"
)


def day_totals(binned: DataFrame, spec: SeriesSpec, session_tz: str) -> DataFrame:
    """(entity, total, day): each entity's sum of each calendar day; NULL where all its values are."""
    day = F.to_date(tf.wallclock(binned, spec.ts, spec.tz, session_tz)).alias("day")
    return binned.groupBy(spec.entity, day).agg(F.sum(spec.value).cast("double").alias("total")).select(spec.entity, "total", "day")


def day_state(totals: DataFrame) -> DataFrame:
    """One row a day: counts, mean and central moments of all and of the positive totals, extremes, sketch."""
    x = F.col("total")
    pos = F.when(x > 0, x)
    n, pos_n = F.count(x), F.count(pos)
    m2, pos_m2 = F.var_pop(x) * n, F.var_pop(pos) * pos_n
    spread = F.when(pos_m2 > 0, pos_m2)
    return totals.where(x.isNotNull()).groupBy("day").agg(
        n.alias("n"),
        F.avg(x).alias("mean"),
        m2.alias("m2"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        pos_n.alias("pos_n"),
        F.avg(pos).alias("pos_mean"),
        pos_m2.alias("pos_m2"),
        # Spark's g1 = sqrt(n) m3 / m2^1.5 and g2 = n m4 / m2^2 - 3, solved for the sums; 0 without spread
        F.coalesce(F.skewness(pos) * F.pow(spread, 1.5) / F.sqrt(pos_n), F.lit(0.0)).alias("pos_m3"),
        F.coalesce((F.kurtosis(pos) + 3) * spread * spread / pos_n, F.lit(0.0)).alias("pos_m4"),
        F.kll_sketch_agg_double(x, SKETCH_K).alias("sketch"),
    )


def update_days(binned: DataFrame, spec: SeriesSpec, root: str, session_tz: str) -> None:
    """Write totals and state of every day in ``binned``, which holds whole days; other days stay.

    Only the given rows are read. The state is written after the totals; a run that ends
    between the two is repeated with the same rows.
    """
    totals = staged(day_totals(binned, spec, session_tz), "day-totals")
    for name, table in (("totals", totals), ("state", day_state(totals))):
        writer = table.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day").parquet(f"{root}/{name}")


def _days(df: DataFrame, first: date | None, last: date | None) -> DataFrame:
    if first is not None:
        df = df.where(F.col("day") >= F.lit(first))
    return df if last is None else df.where(F.col("day") <= F.lit(last))


def stored_totals(spark: SparkSession, spec: SeriesSpec, root: str, entity_type: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Total of each entity over a range of days, both ends included, from the daily totals (A2)."""
    daily = spark.read.schema(f"`{spec.entity}` {entity_type}, total double, day date").parquet(f"{root}/totals")
    return _days(daily, first, last).groupBy(spec.entity).agg(F.sum("total").alias("total"))


def _merged(prefix: str, orders: tuple[int, ...]) -> list[Column]:
    """Sums of central moments about the common mean: each day's own, moved by its mean's distance d."""
    n, d = F.col(f"{prefix}n"), F.col(f"{prefix}mean") - F.col(f"{prefix}grand")
    m2, m3, m4 = (F.col(f"{prefix}m{k}") if k in orders else None for k in (2, 3, 4))
    moved = {2: m2 + n * d * d}
    if 4 in orders:
        moved[3] = m3 + 3 * d * m2 + n * d * d * d
        moved[4] = m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d
    return [F.sum(moved[k]).alias(f"{prefix}s{k}") for k in orders]


def stored_stats(spark: SparkSession, root: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Distribution of the entities' daily totals over a range of days, from a row for each day.

    The columns of ``city_stats``: moments equal a scan of all totals, percentiles come
    from the merged sketch and lie within RANK_ERROR of their rank. One row; counts 0 and
    NULLs where no day has a total.
    """
    state = _days(spark.read.schema(STATE_SCHEMA).parquet(f"{root}/state"), first, last)
    means = state.agg(*[(F.sum(F.col(f"{p}n") * F.col(f"{p}mean")) / F.nullif(F.sum(f"{p}n"), F.lit(0))).alias(f"{p}grand") for p in ("", "pos_")])
    merged = attach_scalars(state, means).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_areas"),
        F.coalesce(F.sum("pos_n"), F.lit(0)).alias("n_positive"),
        F.max("grand").alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        *_merged("", (2,)),
        *_merged("pos_", (2, 3, 4)),
        F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"),
    )
    n, s2 = F.col("n_positive").cast("double"), F.when(F.col("pos_s2") > 0, F.col("pos_s2"))
    g1, g2 = F.sqrt(n) * F.col("pos_s3") / F.pow(s2, 1.5), n * F.col("pos_s4") / (s2 * s2) - 3
    some = F.col("n_areas") > 0
    level = {name: F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(name) for name, p in LEVELS.items()}
    return merged.select(
        "n_areas",
        "n_positive",
        "mean",
        level["median"],
        F.sqrt(F.col("s2") / F.nullif(F.col("n_areas"), F.lit(0))).alias("std"),
        "min",
        "max",
        F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
        *[level[p] for p in ("p1", "p5", "p95", "p99")],
    )


def ranks_within(totals: DataFrame, stats: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """(level, within): whether each percentile of ``stats`` is within ``error`` of its rank among all ``totals``.

    One scan and one aggregate: the share of totals below a value and the share up to it
    enclose its ranks.
    """
    x = F.col("total")
    counted = attach_scalars(totals.where(x.isNotNull()), stats.select(*LEVELS))
    shares = counted.agg(
        *[F.avg((x < F.col(name)).cast("double")).alias(f"{name}_below") for name in LEVELS],
        *[F.avg((x <= F.col(name)).cast("double")).alias(f"{name}_upto") for name in LEVELS],
    )
    pairs = [
        F.struct(F.lit(name).alias("level"), ((F.col(f"{name}_below") <= p + error) & (F.col(f"{name}_upto") >= p - error)).alias("within"))
        for name, p in LEVELS.items()
    ]
    return shares.select(F.inline(F.array(*pairs)))
