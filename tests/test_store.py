import hashlib
import os
from datetime import date

from pyspark.sql import functions as F

from gridseries.plans.ingest import run_ingest
from gridseries.sources import store as st

# F1-style raw day files: epoch ms of local midnights in Europe/Rome
DAYS = {
    "2013-11-01": 1383260400000,
    "2013-11-02": 1383346800000,
    "2013-11-04": 1383519600000,
}


def _write_raw(folder, days):
    os.makedirs(folder, exist_ok=True)
    for day, ms in days.items():
        with open(os.path.join(folder, f"sms-call-internet-mi-{day}.txt"), "w") as f:
            f.write(f"1\t{ms}\t39\t\t\t\t\t2.5\n")
            f.write(f"1\t{ms}\t33\t\t\t\t\t1.5\n")
            f.write(f"2\t{ms + 600000}\t39\t\t\t\t\t1.0\n")
            f.write("bad\tline\n")
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("not a data file\n")
    with open(os.path.join(folder, "sms-call-internet-mi-2013-13-01.txt"), "w") as f:
        f.write("1\t1\t1\t\t\t\t\t1\n")


def test_missing_days(spark):
    present = spark.createDataFrame([(date(2013, 11, 1),), (date(2013, 11, 2),), (date(2013, 11, 4),)], "day date")
    assert [r.day for r in st.missing_days(present).collect()] == [date(2013, 11, 3)]
    got = sorted(r.day for r in st.missing_days(present, date(2013, 10, 31), date(2013, 11, 5)).collect())
    assert got == [date(2013, 10, 31), date(2013, 11, 3), date(2013, 11, 5)]


def test_ingest_end_to_end_and_incremental(spark, tmp_path):
    raw = str(tmp_path / "raw")
    root = str(tmp_path / "store")
    _write_raw(raw, dict(list(DAYS.items())[:2]))
    out = run_ingest(spark, raw, root)
    assert out["plan"].count() == 2
    days = [r.day for r in st.list_partitions(spark, root).collect()]
    assert days == [date(2013, 11, 1), date(2013, 11, 2)]
    data = st.read_store(spark, root)
    assert sorted((r.square_id, r.internet) for r in data.where(F.col("day") == date(2013, 11, 1)).collect()) == [(1, 4.0), (2, 1.0)]
    parts = out["partitions"].collect()
    assert sum(r.rows for r in parts) == 4
    # checksum equals the file's sha256
    f = parts[0]
    with open(os.path.join(root, f.path), "rb") as fh:
        assert hashlib.sha256(fh.read()).hexdigest() == f.sha256
    # second run: only the new day is planned
    _write_raw(raw, DAYS)
    out2 = run_ingest(spark, raw, root)
    assert [r.day for r in out2["plan"].collect()] == [date(2013, 11, 4)]
    assert [r.day for r in out2["missing"].collect()] == [date(2013, 11, 3)]
    m = out2["manifest"].first()
    assert (m.n_partitions, m.total_rows) == (3, 6)
    # force + limit: first day only
    out3 = run_ingest(spark, raw, root, force=True, limit_days=1)
    assert [r.day for r in out3["plan"].collect()] == [date(2013, 11, 1)]


def test_streaming_incremental_ingest(spark, tmp_path):
    from gridseries.streaming.ingest import incremental_ingest

    raw = str(tmp_path / "raw")
    root = str(tmp_path / "store")
    ck = str(tmp_path / "ck")
    _write_raw(raw, dict(list(DAYS.items())[:1]))
    incremental_ingest(spark, raw, root, ck, files_per_batch=1)
    assert st.read_store(spark, root).count() == 2
    _write_raw(raw, DAYS)
    incremental_ingest(spark, raw, root, ck)
    data = st.read_store(spark, root)
    assert data.count() == 6
    assert data.select("day").distinct().count() == 3


def test_load_series_prunes_partitions(spark, tmp_path):
    from datetime import datetime

    raw = str(tmp_path / "raw")
    root = str(tmp_path / "store")
    _write_raw(raw, DAYS)
    run_ingest(spark, raw, root)
    df = st.load_series(spark, root, ids=[1], start=datetime(2013, 11, 2), end=datetime(2013, 11, 2, 23, 50))
    assert [(r.square_id, r.internet) for r in df.collect()] == [(1, 4.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(square_id)" in plan


def test_has_partition_checksums_and_run_log(spark, tmp_path):
    from datetime import date as _date

    from gridseries.operators import reporting as rep

    raw = str(tmp_path / "raw")
    root = str(tmp_path / "store")
    _write_raw(raw, DAYS)
    run_ingest(spark, raw, root)
    assert st.has_partition(spark, root, _date(2013, 11, 2))
    assert not st.has_partition(spark, root, _date(2013, 11, 3))
    sums = st.file_checksums(spark, root).collect()
    assert len(sums) == 3 and all(len(r.sha256) == 64 and r.bytes > 0 for r in sums)
    log = spark.createDataFrame(
        [("dhr", 1, 9.43, 5616, 25.485, 0.0253, 1008)],
        "model string, square_id bigint, train_seconds double, train_steps bigint, "
        "predict_seconds_total double, predict_seconds_per_step_mean double, test_steps bigint",
    )
    path = str(tmp_path / "timing")
    rep.write_run_log(log, path)
    back = rep.read_run_log(spark, path).collect()
    assert [(r.model, r.square_id, r.train_seconds, r.test_steps) for r in back] == [("dhr", 1, 9.43, 1008)]


def _day_file(folder, day, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"sms-call-internet-mi-{day}.txt"), "w") as f:
        f.writelines(r + "\n" for r in rows)


def test_a_spill_row_never_hides_the_next_days_file(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "store")
    d1, d2 = DAYS["2013-11-01"], DAYS["2013-11-02"]
    first = [f"1\t{d1}\t39\t\t\t\t\t1.0", f"2\t{d2}\t39\t\t\t\t\t2.0", "bad one"]
    second = [f"1\t{d2}\t39\t\t\t\t\t3.0", f"70000\t{d2}\t39\t\t\t\t\t4.0", "bad two", "x\t1\t1\t\t\t\t\t1"]
    _day_file(raw, "2013-11-01", first)
    run_ingest(spark, raw, root)
    _day_file(raw, "2013-11-02", second)
    out = run_ingest(spark, raw, root)
    assert sorted((r.day.day, r.square_id, r.internet) for r in st.read_store(spark, root).collect()) == [
        (1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0), (2, 70000, 4.0),
    ]
    assert sorted((r.day.day, r.line) for r in out["quarantine"].collect()) == [(1, "bad one"), (2, "bad two"), (2, second[3])]
    # a mended file leaves no bad line behind
    _day_file(raw, "2013-11-02", second[:2])
    out = run_ingest(spark, raw, root, force=True)
    assert [r.line for r in out["quarantine"].collect()] == ["bad one"]


def test_configured_id_range_and_calendar(spark, tmp_path):
    from gridseries.config import IngestConfig

    raw, root = str(tmp_path / "raw"), str(tmp_path / "store")
    _day_file(raw, "2013-11-01", [f"70000\t{DAYS['2013-11-01']}\t39\t\t\t\t\t1.0", f"7\t{DAYS['2013-11-01']}\t39\t\t\t\t\t1.0"])
    cfg = IngestConfig(max_square_id=65535, expected_first_date="2013-10-31", expected_last_date="2013-11-02")
    out = run_ingest(spark, raw, root, cfg)
    assert out["quarantine"].count() == 1 and st.read_store(spark, root).count() == 1
    assert [r.day for r in out["missing"].orderBy("day").collect()] == [date(2013, 10, 31), date(2013, 11, 2)]


def test_streaming_quarantine_and_batch_guard(spark, tmp_path):
    import pytest

    from gridseries.streaming.ingest import incremental_ingest

    raw, root = str(tmp_path / "raw"), str(tmp_path / "store")
    _write_raw(raw, dict(list(DAYS.items())[:1]))
    incremental_ingest(spark, raw, root, str(tmp_path / "ck"), on_bad_row="quarantine")
    assert [r.line for r in st.read_quarantine(spark, root).collect()] == ["bad\tline"]
    parted = str(tmp_path / "parted")
    _day_file(os.path.join(parted, "file_name=sms-call-internet-mi-2013-11-01.txt"), "2013-11-01", ["x"])
    with pytest.raises(ValueError, match="files_per_batch"):
        incremental_ingest(spark, parted, root, str(tmp_path / "ck2"), files_per_batch=1)


def test_aware_bounds_are_taken_in_the_store_zone(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    raw, root = str(tmp_path / "raw"), str(tmp_path / "store")
    _write_raw(raw, DAYS)
    run_ingest(spark, raw, root)
    # 22:59 UTC on the 1st is one minute before midnight in Rome; 23:10 UTC is already the 2nd there
    end = datetime(2013, 11, 1, 23, 10, tzinfo=timezone.utc)
    got = st.load_series(spark, root, start=end - timedelta(minutes=10), end=end, tz="Europe/Rome").collect()
    assert sorted((r.square_id, r.internet) for r in got) == [(1, 4.0), (2, 1.0)]


def test_store_files_are_sorted(spark, tmp_path):
    rows = [(i % 17, 1383260400 + 600 * i, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "square_id long, t long, internet double")
    df = df.select("square_id", F.timestamp_seconds("t").alias("ts"), F.col("internet").cast("float").alias("internet"))
    df = df.withColumn("day", F.to_date("ts")).withColumn("year_month", F.date_format("day", "yyyy-MM"))
    root = str(tmp_path / "store")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    st.write_store(df, root)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    import pyarrow.parquet as pq

    for r in st.profile_partitions(spark, root).collect():
        t = pq.ParquetFile(os.path.join(root, r.path)).read(["square_id", "ts"]).to_pylist()
        keys = [(x["square_id"], x["ts"]) for x in t]
        assert keys == sorted(keys)
