"""The versioned catalog: only new files are read, versions appear whole, two writers do not lose each other's work."""

import hashlib
import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from gridseries.sources import catalog as cat
from gridseries.sources import store as st

START, END = date(2024, 1, 1), date(2024, 1, 9)


def put_day(spark, root, day, rows=3, value=1.0):
    ts = datetime(2024, 1, day)
    data = [(i, ts + timedelta(minutes=10 * i), value, "2024-01", ts.date()) for i in range(rows)]
    st.write_store(spark.createDataFrame(data, st.STORE_SCHEMA), root)


def test_second_version_opens_new_files_only(spark, tmp_path):
    root = str(tmp_path / "store")
    put_day(spark, root, 1)
    put_day(spark, root, 2, 5)
    first = cat.refresh(spark, root, START, END)
    assert (first["version"], first["hashed_files"], first["n_partitions"], first["total_rows"]) == (1, 2, 2, 8)
    assert cat.refresh(spark, root, START, END)["version"] == 1  # nothing changed
    # an old file that can no longer be read does no harm: it is not opened again
    old = next(os.path.join(d, f) for d, _, names in os.walk(f"{root}/year_month=2024-01/day=2024-01-01") for f in names if f.endswith(".parquet"))
    before = os.stat(old)
    with open(old, "r+b") as f:
        f.write(b"broken")
    os.utime(old, ns=(before.st_atime_ns, before.st_mtime_ns))
    put_day(spark, root, 3)
    second = cat.refresh(spark, root, START, END)
    assert (second["version"], second["hashed_files"], second["n_partitions"], second["total_rows"]) == (2, 1, 3, 11)
    for r in cat.records(spark, root).collect():
        if r.day != "2024-01-01":
            with open(os.path.join(root, r.path), "rb") as f:
                assert hashlib.sha256(f.read()).hexdigest() == r.sha256


def test_replaced_and_removed_files(spark, tmp_path):
    root = str(tmp_path / "store")
    put_day(spark, root, 1)
    put_day(spark, root, 2)
    cat.refresh(spark, root, START, END)
    put_day(spark, root, 1, 7)
    again = cat.refresh(spark, root, START, END)
    assert (again["hashed_files"], again["removed_files"], again["n_partitions"], again["total_rows"]) == (1, 1, 2, 10)
    assert {r.day: r.rows for r in cat.records(spark, root).collect()} == {"2024-01-01": 7, "2024-01-02": 3}


def test_a_version_is_written_once_and_the_loser_looks_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    put_day(spark, root, 1)
    cat.refresh(spark, root, START, END)
    folder = cat.CommitFolder(spark, root)
    assert not folder.put(1, "{}") and cat.latest(spark, root)["total_rows"] == 3
    assert not [n for n in os.listdir(f"{root}/_catalog/commits") if n.endswith(".tmp")]
    put_day(spark, root, 2)
    original, raced = cat.CommitFolder.put, []

    def put(self, version, text):
        if not raced:  # another writer takes the version first
            raced.append(original(self, version, text))
            return False
        return original(self, version, text)

    monkeypatch.setattr(cat.CommitFolder, "put", put)
    last = cat.refresh(spark, root, START, END)
    assert raced == [True] and (last["version"], last["total_rows"]) == (2, 6)


def test_folders_are_compacted_and_an_empty_catalog_has_no_records(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    assert cat.latest(spark, root) is None and cat.records(spark, root).count() == cat.commits(spark, root).count() == 0
    monkeypatch.setattr(cat, "COMPACT_AFTER", 2)
    for day in range(1, 5):
        put_day(spark, root, day)
        last = cat.refresh(spark, root, START, END)
    assert last["version"] == 4 and len(last["folders"]) <= 2
    assert cat.records(spark, root).agg(F.sum("rows")).first()[0] == last["total_rows"] == 12


def test_a_day_s_files_are_removed(spark, tmp_path):
    root = str(tmp_path / "store")
    put_day(spark, root, 1)
    cat.refresh(spark, root, START, END)
    put_day(spark, root, 2)
    day = f"{root}/year_month=2024-01/day=2024-01-01"
    for f in os.listdir(day):
        os.remove(os.path.join(day, f))
    last = cat.refresh(spark, root, START, END)
    assert (last["removed_files"], last["n_partitions"], last["total_rows"]) == (1, 1, 3)
