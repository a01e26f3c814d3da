from datetime import datetime, timedelta

from gridseries.config import SeriesSpec
from gridseries.operators import evaluate as ev
from gridseries.operators import reporting as rep

from .conftest import rows

SPEC = SeriesSpec(entity="id", ts="ts", value="v", step=600, daily=144, weekly=1008, tz="UTC")


def _fc(spark):
    t0 = datetime(2024, 1, 1)
    data = []
    for m in ("a", "b"):
        for i in range(40):
            err = 1.0
            if 20 <= i < 26:
                err = 10.0 if m == "a" else 8.0
            data.append((m, 1, t0 + timedelta(minutes=10 * i), 100.0, 100.0 + err))
    return spark.createDataFrame(data, "model string, id int, ts timestamp_ntz, y_true double, y_pred double")


def test_joint_failure_window(spark):
    f = ev.joint_failure(_fc(spark), SPEC, window=6, multiplier=2.0, n_models=2).collect()
    assert len(f) == 1
    peak = datetime(2024, 1, 1) + timedelta(minutes=10 * 25)
    assert f[0].peak == peak
    assert f[0].start == peak - timedelta(minutes=30) and f[0].end == peak + timedelta(minutes=30)
    assert set(f[0].ratios) == {"a", "b"}


def test_no_joint_spike_gives_no_row(spark):
    t0 = datetime(2024, 1, 1)
    data = [(m, 1, t0 + timedelta(minutes=10 * i), 1.0, 1.0 + (5.0 if (m == "a" and i == 30) else 0.1)) for m in "ab" for i in range(40)]
    df = spark.createDataFrame(data, "model string, id int, ts timestamp_ntz, y_true double, y_pred double")
    assert ev.joint_failure(df, SPEC, n_models=2).count() == 0


def test_upsert_keeps_train_columns(spark):
    # upsert of predict columns keeps existing train columns
    old = spark.createDataFrame([("dhr", 1, 9.4, 5616), ("naive", 1, None, None)], "model string, square_id int, train_seconds double, train_steps int")
    new = spark.createDataFrame([("dhr", 1, 25.5, 1008), ("dhr", 2, 26.0, 1008)], "model string, square_id int, predict_seconds_total double, test_steps int")
    merged = rep.upsert(old, new, ["model", "square_id"], merge_columns=True)
    got = rows(merged, "model", "square_id", "train_seconds", "predict_seconds_total")
    assert got == [("dhr", 1, 9.4, 25.5), ("dhr", 2, None, 26.0), ("naive", 1, None, None)]
    plain = rep.upsert(old, new, ["model", "square_id"], merge_columns=False)
    assert rows(plain.where("model = 'dhr' AND square_id = 1"), "train_seconds") == [(None,)]


def test_merge_summary(spark):
    prev = spark.createDataFrame([(1, 10.0), (2, 20.0)], "square_id int, n_obs double")
    cur = spark.createDataFrame([(2, 21.0), (3, 30.0)], "square_id int, n_obs double")
    assert rows(rep.merge_summary(prev, cur)) == [(1, 10.0), (2, 21.0), (3, 30.0)]


def test_markdown_lines(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 1.0)], "id int, model string, MAE double")
    lines = [r.line for r in rep.markdown_table(df, ["model", "MAE"], ["id", "MAE"]).collect()]
    assert lines == ["| model | MAE |", "|---|---|", "| a | 1.0 |", "| b | 2.0 |"]
