"""The compacted table of bins: exact sums, bounded folders, late rows kept, replays harmless."""

import os
import random
from datetime import datetime, timedelta

from gridseries.config import SeriesSpec
from gridseries.streaming import compacted as comp

SPEC = SeriesSpec(entity="k", ts="ts", value="v", step=3600, daily=24, weekly=168, tz="UTC")
SCHEMA = "k string, ts timestamp_ntz, v double, note string"
T0 = datetime(2024, 1, 1)


def folders(root):
    return sum(len(os.listdir(f"{root}/{kind}")) for kind in ("delta", "late") if os.path.isdir(f"{root}/{kind}"))


def test_sums_late_rows_and_folders(spark, tmp_path):
    rnd = random.Random(3)
    src, out = str(tmp_path / "src"), str(tmp_path / "bins")
    os.makedirs(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    bins, late, newest, commits = {}, [], None, []
    for batch in range(14):
        rows = [(rnd.choice(["a", "b", None]), T0 + timedelta(hours=6 * batch - rnd.randrange(30), minutes=rnd.randrange(60)), rnd.choice([None, 1.0, 2.0, 5.0]), f"n{batch}") for _ in range(25)]
        rows.append(("a", None, 1.0, "no time"))
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        limit = None if newest is None else newest - timedelta(hours=12)
        for k, t, v, note in rows:
            if t is None or v is None:
                continue
            if limit is not None and t <= limit:
                late.append((k, t, v, note, batch))
                continue
            newest = t if newest is None else max(newest, t)
            key = (k, t.replace(minute=0))
            bins[key] = bins.get(key, 0) + v
        comp.upsert_bins(stream, SPEC, "k", "ts", "v", out, delay=12 * 3600, keep=3)
        got = {(r.k, r.ts): r.v for r in comp.read_bins(spark, out, SPEC, "string").collect()}
        assert got == bins
        commits.append(len(os.listdir(f"{out}/_catalog/commits")))
        assert folders(out) <= 3 + 3 + 3 * 3 + 2
    order = lambda r: (str(r[0]), *r[1:])
    kept = [tuple(r) for r in comp.late_rows(spark, out, SCHEMA).select("k", "ts", "v", "note", "_batch").collect()]
    assert sorted(kept, key=order) == sorted(late, key=order) and len(late) > 20
    last, state = comp._state(spark, out)
    assert last == 13 and state["late_rows"] == len(late)
    assert max(commits) <= 4  # two versions and their checksum files
    # a base day that no later batch touched is still the file that was written first
    assert len(set(state["base"].values())) > 1


def test_a_batch_that_failed_before_its_commit_is_written_again(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "src"), str(tmp_path / "bins")
    os.makedirs(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    put, calls = comp.CommitFolder.put, []

    def failing(self, version, text):
        calls.append(version)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return put(self, version, text)

    monkeypatch.setattr(comp.CommitFolder, "put", failing)
    for i in range(3):
        spark.createDataFrame([("a", T0 + timedelta(hours=i), 1.0 + i, "")], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        try:
            comp.upsert_bins(stream, SPEC, "k", "ts", "v", out, keep=2)
        except Exception as e:
            assert "lost" in str(e)
    got = sorted((r.ts.hour, r.v) for r in comp.read_bins(spark, out, SPEC, "string").collect())
    assert got == [(0, 1.0), (1, 2.0), (2, 3.0)] and calls[:3] == [0, 1, 1]
    assert comp.late_rows(spark, out, SCHEMA).count() == 0


def test_a_folder_without_a_commit_is_an_empty_table(spark, tmp_path):
    assert comp.read_bins(spark, str(tmp_path / "none"), SPEC, "string").count() == 0
    assert comp.late_rows(spark, str(tmp_path / "none"), SCHEMA).columns == ["k", "ts", "v", "note", "_batch"]
