"""Spark-side harmonic regression, saved models, plug-in forecasters, linear-time windows."""

import math
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.config import HOURLY, Split
from gridseries.operators import distribution as dist
from gridseries.operators import evaluate as ev
from gridseries.operators import forecast as fc
from gridseries.operators import harmonic as har
from gridseries.operators import reporting as rep
from gridseries.operators import series as ser
from gridseries.operators import windows as win
from gridseries.plans import models

SPEC = HOURLY
T0 = datetime(2024, 1, 1)
SPLIT = Split(
    train_start=T0, train_end=T0 + timedelta(hours=399), val_start=T0 + timedelta(hours=400), val_end=T0 + timedelta(hours=449),
    test_start=T0 + timedelta(hours=450), test_end=T0 + timedelta(hours=499),
)


@pytest.fixture(scope="module")
def series(spark):
    """Two periodic series, one that starts after training, one too short for the regressors, one constant."""
    rng = np.random.default_rng(4)
    rows = []
    for e, n0 in (("a", 0), ("b", 0), ("late", 420), ("short", 370), ("flat", 0)):
        noise = 0.0
        for h in range(n0, 500):
            noise = 0.6 * noise + rng.normal()
            season = 20 * math.sin(2 * math.pi * h / 24) + 8 * math.cos(2 * math.pi * h / 168)
            v = 5.0 if e == "flat" else 100 + season + noise
            rows.append((e, T0 + timedelta(hours=h), v))
    schema = f"{SPEC.entity} string, {SPEC.ts} timestamp_ntz, {SPEC.value} double"
    return spark.createDataFrame(rows, schema)


def test_harmonic_beats_last_value_and_keeps_every_entity(series):
    f = har.harmonic_forecasts(series, SPEC, SPLIT).unionByName(fc.last_value(series, SPEC))
    assert f.where("model = 'harmonic'").count() == series.count()
    m = {(r[SPEC.entity], r.model): r.MAE for r in ev.metrics_table(ev.walk_forward(f, SPEC, SPLIT.test_start, SPLIT.test_end), SPEC).collect()}
    assert all(m[e, "harmonic"] < 0.5 * m[e, "naive_last"] for e in "ab")
    assert m["late", "harmonic"] == m["late", "naive_last"] and m["short", "harmonic"] == m["short", "naive_last"]
    assert m["flat", "harmonic"] < 1e-6


def test_harmonic_coefficients_equal_least_squares(series):
    p = {r[SPEC.entity]: r for r in har.harmonic_fit(series, SPEC, SPLIT, use_log1p=False).collect()}
    y = np.array([r[SPEC.value] for r in series.where(F.col(SPEC.entity) == "a").orderBy(SPEC.ts).limit(400).collect()])
    s = np.arange(400)
    x = np.column_stack([np.ones(400)] + [f(2 * np.pi * k * s / n) for n, terms in ((24, 4), (168, 3)) for k in range(1, terms + 1) for f in (np.sin, np.cos)])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose(p["a"].beta, beta, atol=1e-8)
    r = y - x @ beta
    lags = np.column_stack([r[1:-1], r[:-2]])
    assert np.allclose([p["a"].phi1, p["a"].phi2], np.linalg.lstsq(lags, r[2:], rcond=None)[0], atol=1e-8)
    assert "late" not in p and p["short"].beta is None and len(p) == 4


def test_sparse_series_never_diverge(spark):
    from gridseries.plans import bindings as b

    cells = b.cells_hourly(spark, "/root/testdata/sf0.001")
    f = har.harmonic_forecasts(cells, b.EVENTS_CELLS, b.SPLIT).unionByName(fc.last_value(cells, b.EVENTS_CELLS))
    m = ev.metrics_table(ev.walk_forward(f, b.EVENTS_CELLS, b.SPLIT.test_start, b.SPLIT.test_end), b.EVENTS_CELLS)
    wide = m.groupBy("user_id").pivot("model", ["harmonic", "naive_last"]).agg(F.first("MAE"))
    assert wide.where("harmonic > 10 * naive_last").count() == 0


@pytest.mark.parametrize("family", ["harmonic", "learned_linear"])
def test_saved_models_forecast_like_fresh_ones(spark, series, tmp_path, family):
    models.train(series, SPEC, SPLIT, str(tmp_path), [family])
    saved = models.forecast_trained(spark, series, SPEC, str(tmp_path), family)
    fresh = fc.get_forecaster(family, SPEC)(series, split=SPLIT)
    key = [SPEC.entity, SPEC.ts]
    both = saved.select(*key, F.col("y_pred").alias("p")).join(fresh.select(*key, F.col("y_pred").alias("q")), key)
    assert both.count() == series.count() == fresh.count()
    assert both.where("abs(p - q) > 1e-9 OR (p IS NULL) <> (q IS NULL)").count() == 0
    assert fresh.where(F.col(SPEC.entity) == "late").count() == 80
    with pytest.raises(ValueError):
        models.train(series, SPEC, SPLIT, str(tmp_path), ["nothing"])


def test_a_registered_forecaster_is_evaluated_like_the_others(spark, series, tmp_path):
    def twice(s, spec, split=None):
        return fc.last_value(s, spec, "twice").withColumn("y_pred", F.col("y_pred") * 2)

    fc.register_forecaster("twice", twice)
    out = models.forecast(spark, series, SPEC, SPLIT, ["naive_last", "twice"], str(tmp_path / "f"))
    assert {r.model: r["count"] for r in out.groupBy("model").count().collect()} == {"naive_last": 250, "twice": 250}
    assert len(list((tmp_path / "f").glob("model=*"))) == 2
    with pytest.raises(ValueError):
        fc.register_forecaster("harmonic", twice)
    with pytest.raises(ValueError):
        fc.get_forecaster("nothing", SPEC)


def test_interpolation_and_rolling_are_linear_and_right(spark):
    n = 36_000
    df = spark.range(n).select(
        F.lit("x").alias(SPEC.entity),
        F.expr("timestampadd(HOUR, id, TIMESTAMP_NTZ'2020-01-01 00:00:00')").alias(SPEC.ts),
        F.when(F.col("id") % 5 != 2, F.sin(F.col("id") / 50) * 100).alias(SPEC.value),
    )
    t = time.time()
    pdf = ser.interpolate(df, SPEC).orderBy(SPEC.ts).toPandas()
    assert time.time() - t < 15
    full = spark.createDataFrame(pdf)
    want = df.orderBy(SPEC.ts).toPandas()[SPEC.value].interpolate(limit_direction="both")
    assert np.allclose(pdf[SPEC.value], want)
    full = ser.interpolate(df, SPEC)
    for w in (24, 1009, 1):
        t = time.time()
        got = win.rolling_stats(full, SPEC, w).orderBy(SPEC.ts).toPandas()
        assert time.time() - t < 20
        roll = want.rolling(w)
        assert np.allclose(got["rolling_mean"], roll.mean(), equal_nan=True)
        assert np.allclose(got["rolling_std"], roll.std(), equal_nan=True, atol=1e-6)


def test_exact_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=500).round(1), np.full(300, 7.0)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "total double").repartition(7)
    got = dist.exact_percentiles(df, "total", {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.937, "e": 1.0}).first()
    assert np.allclose(list(got), np.quantile(values, [0.0, 0.01, 0.5, 0.937, 1.0]))
    assert dist.exact_percentiles(df.limit(0), "total", {"a": 0.5}).first().a is None


def test_grid_side_follows_the_ids_and_loses_none(spark):
    t = spark.createDataFrame([(1, 1.0), (17, 2.0)], "id long, total double")
    g = dist.spatial_grid(t, spark, "id")
    assert g.count() == 25 and g.where("total IS NOT NULL").count() == 2
    with pytest.raises(Exception, match="outside the grid"):
        dist.spatial_grid(t, spark, "id", side=4).count()


def test_csv_folders_and_summaries(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id long, v double")
    rep.write_partitioned_csv(df, path, "id")
    rep.write_partitioned_csv(df.where("id = 1"), path, "id")
    assert [p.name for p in (tmp_path / "csv").glob("id=*")] == ["id=1"]
    old = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y")], "square_id long, a double, only_old string")
    new = spark.createDataFrame([(2, 9.0, 5), (3, 3.0, 6)], "square_id long, a double, only_new long")
    got = {r.square_id: (r.a, r.only_old, r.only_new) for r in rep.merge_summary(old, new).collect()}
    assert got == {1: (1.0, "x", None), 2: (9.0, "y", 5), 3: (3.0, None, 6)}
    from gridseries.plans.eda import write_summary

    target = str(tmp_path / "summary")
    write_summary(new, target, "square_id")
    write_summary(new.withColumn("a", F.lit(0.0)).where("square_id = 3"), target, "square_id")
    assert {r.square_id: r.a for r in spark.read.json(target).collect()} == {2: 9.0, 3: 0.0}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "summary"]


def test_a_cluster_session_needs_the_shared_folder(spark, monkeypatch):
    from gridseries import session

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    Session.conf = Conf({"spark.master": "spark://host:7077", "spark.checkpoint.dir": "hdfs:///shared"})
    assert session.ensure_checkpoint_dir(Session()) == "hdfs:///shared"
