"""Windows as views over chunks against the windows as arrays."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from gridseries.config import SeriesSpec
from gridseries.operators import features as feat
from gridseries.operators import sequences as seq

SPEC = SeriesSpec(entity="k", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
SCHEMA = "k int, ts timestamp_ntz, v double, w double"
T0 = datetime(2024, 1, 1)
LEN = 5
OUT = ", ".join(f"{c}{i} double" for c in "vw" for i in range(LEN))


def flat(x: np.ndarray) -> dict[str, np.ndarray]:
    assert x.shape[1:] == (LEN, 2)
    return {f"{c}{i}": x[:, i, j] for j, c in enumerate("vw") for i in range(LEN)}


@pytest.mark.parametrize("size", [5, 7, 4096])
@pytest.mark.parametrize("arrow", [3, 10_000])
def test_same_rows_as_the_array_form(spark, size, arrow):
    rnd = random.Random(1)
    # an entity of many chunks, a null one, one with too short a history, one of exactly a window and a target
    rows = [(k, T0 + timedelta(hours=i), None if rnd.random() < 0.1 else rnd.random(), float(i)) for k, n in ((1, 61), (None, 23), (3, 4), (4, 6), (5, 35)) for i in range(n) if rnd.random() < 0.95 or n < 10]
    rnd.shuffle(rows)
    s = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow))
    try:
        got = seq.sequence_batches(s, SPEC, LEN, ["v", "w"], flat, OUT, ["w"], size).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = feat.sliding_windows(s, SPEC, LEN, ["v", "w"]).collect()
    have = {(r.k, r.ts): ([r[f"v{i}"] for i in range(LEN)], [r[f"w{i}"] for i in range(LEN)], r.w) for r in got}
    assert have == {(r.k, r.ts): ([x.v for x in r.window], [x.w for x in r.window], r.w) for r in want}
    assert len(got) == len(want) > 80


def test_empty_series_and_plan(spark):
    s = spark.createDataFrame([], SCHEMA)
    out = seq.sequence_batches(s, SPEC, LEN, ["v", "w"], flat, OUT)
    assert out.count() == 0 and out.columns[:2] == ["k", "ts"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan
