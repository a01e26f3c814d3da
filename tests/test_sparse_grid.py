"""Sparse grid: rows follow the entities whatever their ids; the dense view equals it; binned density equals the direct sum."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.operators import distribution as dist


def _totals(spark, pairs):
    return spark.createDataFrame(pairs, "id long, total double")


def test_ids_far_apart_cost_a_row_each(spark):
    ids = [1, 10**10, 10**10 - 7, 10**18]
    cells = dist.occupied_cells(_totals(spark, [(i, 1.0) for i in ids] + [(None, 5.0)]), "id").collect()
    side = math.isqrt(10**18 - 1) + 1
    assert {(r.id, r.row, r.col) for r in cells} == {(i, (i - 1) // side, (i - 1) % side) for i in ids}


@pytest.mark.parametrize("largest", [1, 2, 4, 5, 9, 10, 10**10, 10**10 + 1, (2**31 - 1) ** 2, (2**31 - 1) ** 2 + 1, 2**62])
def test_side_is_exact(spark, largest):
    assert spark.range(1).select(dist.square_side(F.lit(largest))).first()[0] == math.isqrt(largest - 1) + 1


def test_dense_view_and_window_equal_the_cells(spark):
    t = _totals(spark, [(1, 1.0), (17, 2.0), (25, 0.0), (13, None)])
    whole = {(r.row, r.col): r.total for r in dist.spatial_grid(t, spark, "id").collect()}
    cells = {(r.row, r.col): r.total for r in dist.occupied_cells(t, "id").collect()}
    assert len(whole) == 25 and {k: v for k, v in whole.items() if k in cells} == cells
    part = {(r.row, r.col): r.total for r in dist.spatial_grid(t, spark, "id", window=(2, 1, 9, 3)).collect()}
    assert part == {k: v for k, v in whole.items() if k[0] >= 2 and 1 <= k[1] <= 3}
    far = dist.spatial_grid(_totals(spark, [(10**12, 3.0)]), spark, "id", window=(10**6 - 2, 10**6 - 2, 2, 2)).collect()
    assert len(far) == 4 and [r.id for r in far if r.total == 3.0] == [10**12]


def test_tiles_sum_their_cells(spark):
    rng = np.random.default_rng(0)
    ids = rng.choice(10**6, 500, replace=False) + 1
    cells = dist.occupied_cells(_totals(spark, [(int(i), float(i % 7)) for i in ids]), "id", side=1000)
    got = {(r.tile_row, r.tile_col): (r.n_cells, r.n_nonzero, r.total, r.max_total) for r in dist.grid_tiles(cells, 100).collect()}
    want = {}
    for i in ids.tolist():
        n, nz, s, m = want.get(key := ((i - 1) // 1000 // 100, (i - 1) % 1000 // 100), (0, 0, 0.0, 0.0))
        want[key] = (n + 1, nz + (i % 7 > 0), s + i % 7, max(m, i % 7))
    assert got == want


@pytest.mark.parametrize("bad", [0, -3])
def test_ids_below_one_fail(spark, bad):
    with pytest.raises(Exception, match="outside the grid"):
        dist.occupied_cells(_totals(spark, [(bad, 1.0), (5, 1.0)]), "id").collect()


def test_binned_density_equals_the_direct_sum(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(2, 0.3, 6000), rng.normal(5, 0.05, 2000), [9.0]])
    got = np.array([r.density for r in dist.kde(spark.createDataFrame([(float(10**v),) for v in x], "total double").repartition(5), 200).orderBy("point").collect()])
    h = x.std(ddof=1) * len(x) ** -0.2
    direct = np.exp(-0.5 * ((np.linspace(x.min(), x.max(), 200)[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert np.abs(got - direct).max() < 1e-10
