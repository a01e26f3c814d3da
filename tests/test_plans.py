import os
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from gridseries.config import DhrConfig, EdaConfig, SeriesSpec, Split
from gridseries.operators import features as feat
from gridseries.operators import reporting as rep
from gridseries.plans import eda, models

SPEC = SeriesSpec(entity="square_id", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
T0 = datetime(2024, 1, 1)
SPLIT = Split(T0, datetime(2024, 1, 21, 23), datetime(2024, 1, 22), datetime(2024, 1, 24, 23), datetime(2024, 1, 25), datetime(2024, 1, 30, 23))


def synthetic(spark, n=3, days=30):
    rng = np.random.default_rng(11)
    rows = []
    for e in range(1, n + 1):
        for i in range(24 * days):
            v = 50 * e + 10 * np.sin(2 * np.pi * i / 24) + 4 * np.sin(2 * np.pi * i / 168) + rng.normal()
            rows.append((e, T0 + timedelta(hours=i), float(v)))
    return spark.createDataFrame(rows, "square_id int, ts timestamp_ntz, v double")


def test_eda_summary_all_entities(spark):
    s = synthetic(spark)
    out = eda.per_entity_summary(s, SPEC, EdaConfig(), method="classical").collect()
    assert len(out) == 3
    r = out[0].asDict()
    for k in ("adf_stat", "kpss_stat", "adf_stat_diff1", "seasonal_strength_daily", "acf_daily", "outliers_count", "drop_runs_count"):
        assert k in r
    assert all(x.seasonal_strength_daily > 0.8 for x in out)
    stl_out = eda.per_entity_summary(s, SPEC, EdaConfig(), method="stl").collect()
    assert all(x.seasonal_strength_daily > 0.8 for x in stl_out)


def test_train_forecast_evaluate(spark, tmp_path):
    s = synthetic(spark)
    params = models.train_dhr(s, SPEC, SPLIT, str(tmp_path / "params"), DhrConfig(p=1, q=1, daily_terms=2, weekly_terms=1))
    assert params.count() == 3
    f = models.forecast(spark, s, SPEC, SPLIT, ["naive_last", "naive_daily", "dhr"], str(tmp_path / "fc"), params=params)
    assert f.select("model").distinct().count() == 3
    res = models.evaluate(f, SPEC, str(tmp_path / "eval"))
    board = res["leaderboard"].where("rank = 1").collect()
    assert all(r.model == "dhr" for r in board)
    assert os.path.isdir(tmp_path / "eval" / "metrics")
    lines = [r.line for r in res["comparison"].collect()]
    assert lines[0].startswith("| square_id | model |")
    # forecasts read back by requested pairs, absent pairs reported
    req = spark.createDataFrame([("dhr", 1), ("naive_weekly", 1)], "model string, square_id int")
    got, missing = rep.read_forecasts(spark, str(tmp_path / "fc"), req, "square_id")
    assert got.select("model").distinct().collect()[0].model == "dhr"
    assert [(r.model, r.square_id) for r in missing.collect()] == [("naive_weekly", 1)]


def test_unknown_model_raises(spark, tmp_path):
    import pytest

    with pytest.raises(ValueError):
        models.forecast(spark, synthetic(spark, 1, 10), SPEC, SPLIT, ["naive_last", "prophet"], str(tmp_path / "x"))


def test_json_summary_skips_corrupt(spark, tmp_path):
    p = tmp_path / "summary.json"
    p.write_text('{"square_id": 1, "n_obs": 5}\n{not json\n')
    df = rep.read_json_summary(spark, str(p), "square_id bigint, n_obs bigint")
    assert [(r.square_id, r.n_obs) for r in df.collect()] == [(1, 5)]
    empty = rep.read_json_summary(spark, str(tmp_path / "absent.json"), "square_id bigint, n_obs bigint")
    assert empty.count() == 0


def test_sliding_windows_and_scaler(spark):
    s = synthetic(spark, 1, 7)
    sc = feat.fit_scaler(s, SPEC, SPLIT).first()
    assert sc.scale_std > 0
    z = feat.scaled(s, SPEC, feat.fit_scaler(s, SPEC, SPLIT))
    w = feat.sliding_windows(z, SPEC, 5, ["z"])
    assert w.count() == 24 * 7 - 5
    first = w.orderBy("ts").first()
    assert len(first.window) == 5
    cal = feat.calendar_features(s, SPEC).where(F.col("ts") == datetime(2024, 1, 6, 6)).first()
    assert cal.is_weekend == 1.0 and abs(cal.tod_sin - 1.0) < 1e-12


def test_write_summary_merges_previous(spark, tmp_path):
    path = str(tmp_path / "eda_summary")
    first = spark.createDataFrame([(1, 10.0), (2, 20.0)], "square_id bigint, n_obs double")
    eda.write_summary(first, path, "square_id")
    second = spark.createDataFrame([(2, 21.0), (3, 30.0)], "square_id bigint, n_obs double")
    eda.write_summary(second, path, "square_id")
    back = spark.read.schema("square_id bigint, n_obs double").json(path)
    assert sorted((r.square_id, r.n_obs) for r in back.collect()) == [(1, 10.0), (2, 21.0), (3, 30.0)]


def test_train_log_from_params(spark):
    from gridseries.operators import grouped as gm

    p = gm.dhr_fit(synthetic(spark, 2, 25), SPEC, SPLIT, DhrConfig(p=1, q=0, daily_terms=1, weekly_terms=1))
    log = models.train_log(p, "square_id").collect()
    assert len(log) == 2 and all(r.train_seconds >= 0 and r.train_steps == 24 * 21 for r in log)


def test_multi_area_preview(spark):
    s = synthetic(spark, 3, 20)
    p = eda.multi_area_preview(s, SPEC, [1, 3], datetime(2024, 1, 1), days=14)
    assert p.select("square_id").distinct().count() == 2
    assert p.count() == 2 * 14 * 24
    assert p.agg(F.max("ts")).first()[0] == datetime(2024, 1, 14, 23)


def test_run_eda_writes_outputs(spark, tmp_path):
    out = str(tmp_path / "eda")
    res = eda.run_eda(synthetic(spark, 2, 16), SPEC, out, method="classical", grid_side=10)
    assert res["summary"].count() == 2
    for name in ("eda_summary", "anomalies", "area_top", "city_stats", "spatial"):
        assert os.path.isdir(os.path.join(out, name))
    top = spark.read.text(os.path.join(out, "area_top")).first().value
    assert top == "2"
