"""Window operators over series cut into many small chunks, against the SQL twins of their queries."""

import pytest

from gridseries.operators import chunks
from gridseries.plans import registry

from . import test_oracle_small as twins
from .test_oracle_small import duck  # noqa: F401

KEYS = ["cells_rolling", "cells_interpolate", "drop_runs", "seasonal_diff", "preview", "rolling_stats", "interpolate", "forecast_last", "forecast_seasonal", "strengths"]


@pytest.mark.parametrize("key", KEYS)
def test_many_chunks_give_the_same_rows(spark, duck, key, monkeypatch):  # noqa: F811
    monkeypatch.setattr(chunks, "CHUNK_STEPS", 31)
    for name in ("S", "C", "TEN"):
        monkeypatch.setattr(registry, name, getattr(registry, name).with_(long=True))
    twins.test_query_matches_sql_twin(spark, duck, key)


def test_a_series_is_dealt_over_many_tasks(spark, monkeypatch):
    """One entity's 3,000 rows meet in windows of at most a chunk and its halo."""
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from gridseries.config import SeriesSpec
    from gridseries.operators import windows

    spec = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC", long=True)
    monkeypatch.setattr(chunks, "CHUNK_STEPS", 100)
    rows = [(1, datetime(2024, 1, 1) + timedelta(hours=i), float(i % 7)) for i in range(3000)]
    series = spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double")
    sizes = chunks.halo_windows(series, spec, 23, 24).groupBy("id", chunks.CHUNK).count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] >= 25 and sizes[1] <= 120 + 23
    got = {r.ts: r.rolling_mean for r in windows.rolling_stats(series, spec, 24).collect()}
    for i, (_, ts, _) in enumerate(rows):
        want = sum(v for _, _, v in rows[i - 23 : i + 1]) / 24 if i >= 23 else None
        assert got[ts] is None if want is None else abs(got[ts] - want) < 1e-9


def test_runs_across_chunks(spark, monkeypatch):
    import random
    from datetime import datetime, timedelta
    from itertools import groupby

    from pyspark.sql import functions as F

    from gridseries.config import SeriesSpec
    from gridseries.operators import windows

    spec = SeriesSpec(entity="id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC", long=True)
    monkeypatch.setattr(chunks, "CHUNK_STEPS", 8)
    rnd = random.Random(1)
    flags = [rnd.random() < p for p in (0.9, 0.5, 0.99, 0.05) for _ in range(60)] + [True] * 40
    rows = [(1, datetime(2024, 1, 1) + timedelta(hours=i), float(i), f) for i, f in enumerate(flags)]
    series = spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double, f boolean")
    got = sorted((r.start, r.end, r.length, round(r.mean_v, 9)) for r in windows.runs(series, spec, "f", 2, "v").collect())
    want, at = [], 0
    for flag, run in groupby(flags):
        n = len(list(run))
        if flag and n >= 2:
            want.append((rows[at][1], rows[at + n - 1][1], n, round(at + (n - 1) / 2, 9)))
        at += n
    assert got == want
    assert windows.runs(series.where(F.lit(False)), spec, "f", 2, "v").count() == 0
