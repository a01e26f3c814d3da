"""Mergeable daily state: moments equal a scan, sketches keep their rank error, a day can be written again."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest

from gridseries.config import SeriesSpec
from gridseries.operators import daystate as ds
from gridseries.operators import distribution as dist
from gridseries.operators.series import area_totals

SPEC = SeriesSpec(entity="cell", ts="ts", value="value", step=3600, daily=24, weekly=168)


def _rows(seed, days, cells=300):
    rng = np.random.default_rng(seed)
    return [
        (c, datetime(2024, 1, d, h), None if rng.random() < 0.05 else float(rng.lognormal(3, 2) * d + 1e4))
        for d in days
        for c in range(cells)
        for h in (3, 15)
    ]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "cell long, ts timestamp_ntz, value double")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "state")


def test_state_of_two_runs_equals_a_scan(spark, root):
    first, second, again = _rows(1, (1, 2, 3)), _rows(2, (4, 5)), _rows(3, (2,))
    for rows in (first, second, again):
        ds.update_days(_frame(spark, rows), SPEC, root, "UTC")
    now = _frame(spark, [r for r in first if r[1].day != 2] + second + again)
    daily = ds.day_totals(now, SPEC, "UTC")
    want = dist.city_stats(daily.drop("day")).first()
    got = ds.stored_stats(spark, root).first()
    assert got.__fields__ == want.__fields__
    for name in want.__fields__:
        if name not in ds.LEVELS:
            assert got[name] == pytest.approx(want[name], rel=1e-9), name
    assert all(r.within for r in ds.ranks_within(daily, ds.stored_stats(spark, root)).collect())
    totals = {r.cell: r.total for r in ds.stored_totals(spark, SPEC, root, "long").collect()}
    assert totals == pytest.approx({r.cell: r.total for r in area_totals(now, SPEC).collect()})


def test_a_range_of_days_reads_those_only(spark, root):
    rows = _rows(4, (1, 2, 3, 4), cells=50)
    ds.update_days(_frame(spark, rows), SPEC, root, "UTC")
    part = _frame(spark, [r for r in rows if r[1].day in (2, 3)])
    want = dist.city_stats(ds.day_totals(part, SPEC, "UTC")).first()
    stats = ds.stored_stats(spark, root, date(2024, 1, 2), date(2024, 1, 3))
    assert stats.first().skew == pytest.approx(want.skew) and stats.first().n_areas == want.n_areas
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    none = ds.stored_stats(spark, root, date(2025, 1, 1)).first()
    assert none.n_areas == none.n_positive == 0 and none.mean is None and none.median is None and none.skew is None


def test_equal_totals_and_days_without_positive_ones(spark, root):
    start = datetime(2024, 1, 1)
    rows = [(c, start + timedelta(days=d), [5.0, 0.0, -1.0, None][d]) for d in range(4) for c in range(6)]
    ds.update_days(_frame(spark, rows), SPEC, root, "UTC")
    got = ds.stored_stats(spark, root).first()
    assert (got.n_areas, got.n_positive, got.min, got.max) == (18, 6, -1.0, 5.0)
    assert got.skew is None and got.kurtosis is None and got.median == 0.0
