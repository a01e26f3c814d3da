"""Forecasts of a stream out of order equal the windows over the sorted series."""

import os
import random
from datetime import datetime, timedelta

import pytest

from gridseries.config import SeriesSpec
from gridseries.operators import forecast as fc
from gridseries.streaming import ordered

SPEC = SeriesSpec(entity="k", ts="ts", value="v", step=3600, daily=6, weekly=42, tz="UTC")
T0 = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, v double"


def run(spark, root, batches, **kw):
    os.makedirs(f"{root}/src")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/src")
    online = ordered.ordered_forecasts(stream, SPEC, 6, "8 hours", **kw)
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/src")
        out = ordered.drain(online, f"{root}/out")
    return out


def test_arrival_order_within_the_watermark_does_not_matter(spark, tmp_path):
    rnd = random.Random(4)
    # gaps, rows off the step, missing values, a null entity and an entity with a gap of several seasons
    rows = [(k, T0 + timedelta(hours=i, minutes=30 * (rnd.random() < 0.1)), None if rnd.random() < 0.1 else float(rnd.randrange(50))) for k in ("a", "b", None) for i in range(60) if rnd.random() < 0.8 and not (k == "b" and 10 < i < 40)]
    arrival = sorted(rows, key=lambda r: r[1] + timedelta(hours=7.9 * rnd.random()))
    arrival[5:5] = [rows[0], (rows[0][0], rows[0][1], None)]  # the same time again, and without a value
    closing = [("z", T0 + timedelta(days=9), 1.0)]
    out = run(spark, str(tmp_path), [arrival[:50], arrival[50:90], arrival[90:], closing]).collect()
    got = {}
    for r in out:
        got[r.k, r.ts, "last"], got[r.k, r.ts, "season"] = r.pred_last, r.pred_seasonal
    want = {(r.k, r.ts, r.model): r.y_pred for r in fc.baseline_forecasts(spark.createDataFrame(rows, SCHEMA), SPEC, {"last": None, "season": 6}).collect()}
    assert got == want and len(out) == len(rows)
    assert all((r.y_true is None) == (r.abs_err_last is None) or r.pred_last is None for r in out)


def test_late_rows_change_nothing_and_idle_entities_start_anew(spark, tmp_path):
    at = lambda h: T0 + timedelta(hours=h)
    batches = [
        [("a", at(0), 1.0), ("a", at(1), 2.0)],
        [("b", at(30), 5.0)],  # the watermark goes to 22 h: a's rows are answered
        [("a", at(3), 99.0), ("b", at(80), 6.0)],  # late: dropped; a was idle for more than a day
        [("b", at(81), 7.0)],
        [("a", at(100), 3.0), ("b", at(130), 8.0)],
        [("z", at(200), 0.0)],
    ]
    out = run(spark, str(tmp_path), batches, idle=86400).collect()
    got = sorted((r.k, int((r.ts - T0).total_seconds() // 3600), r.pred_last) for r in out)
    assert [g for g in got if g[0] == "a"] == [("a", 0, None), ("a", 1, 1.0), ("a", 100, None)]
    assert [g[1] for g in got if g[0] == "b"] == [30, 80, 81, 130]


def test_an_empty_source_answers_nothing(spark, tmp_path):
    assert run(spark, str(tmp_path), [[]]).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_columns(spark, kind):
    stream = spark.readStream.format("rate").load().selectExpr(f"cast(value as {kind}) k", "timestamp ts", "cast(value as double) v")
    out = ordered.ordered_forecasts(stream, SPEC, 6)
    assert out.columns == ["k", "ts", "y_true", "pred_last", "pred_seasonal", "abs_err_last", "abs_err_seasonal"]
    assert dict(out.dtypes)["k"] == kind and dict(out.dtypes)["ts"] == "timestamp"
