"""A versioned catalog of the store's files.

``_catalog/log`` holds one immutable folder of file records for each change, ``_catalog/commits`` one small file for
each version, which names the folders that make up the state and the totals of the manifest. A version appears by a
rename that fails if another writer was first; the loser looks again. Only files that the last version does not
know, by path, size and time, are opened and hashed.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import read_store

RECORDS = "path string, day string, rows bigint, bytes bigint, sha256 string, modified timestamp, version bigint, present boolean"
COMMITS = (
    "version bigint, folders array<string>, generated_at string, expected_start string, expected_end string, n_partitions bigint, "
    "total_rows bigint, total_bytes bigint, hashed_files bigint, hashed_days bigint, removed_files bigint"
)
#: After so many folders a version holds its whole state in one.
COMPACT_AFTER = 10
ATTEMPTS = 5


class CommitFolder:
    """The ``_catalog`` folder of a table through Hadoop's file system, wherever the table lies."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/_catalog"
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at = self.path(f"{self.root}/commits")
        names = [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit())

    def put(self, version: int, text: str) -> bool:
        """Make ``version`` appear whole; False if it is there already."""
        target = self.path(f"{self.root}/commits/{version:012d}.json")
        fresh = self.path(f"{self.root}/commits/.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(fresh, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.exists(target) and self.fs.rename(fresh, target):
            return True
        self.fs.delete(fresh, False)
        return False

    def read(self, version: int) -> dict:
        """What :meth:`put` wrote."""
        return json.loads(self.spark.read.text(f"{self.root}/commits/{version:012d}.json", wholetext=True).first()[0])

    def forget(self, version: int) -> None:
        """Drop an old version's file."""
        self.fs.delete(self.path(f"{self.root}/commits/{version:012d}.json"), False)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All versions so far, one row each."""
    folder = CommitFolder(spark, root)
    if not folder.versions():
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).json(f"{folder.root}/commits")


def latest(spark: SparkSession, root: str) -> dict | None:
    """The last version's commit, read from its one file."""
    folder = CommitFolder(spark, root)
    versions = folder.versions()
    if not versions:
        return None
    return spark.read.schema(COMMITS).json(f"{folder.root}/commits/{versions[-1]:012d}.json").first().asDict()


def _state(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Records of the files that are present: the newest one of each path."""
    if not folders:
        return spark.createDataFrame([], RECORDS)
    log = spark.read.schema(RECORDS).parquet(*[f"{root.rstrip('/')}/_catalog/log/{f}" for f in folders])
    newest = log.groupBy("path").agg(F.max_by(F.struct(*[c for c in log.columns if c != "path"]), "version").alias("r"))
    return newest.select("path", "r.*").where("present")


def records(spark: SparkSession, root: str) -> DataFrame:
    """(day, path, rows, bytes, sha256) of the last version's files."""
    now = latest(spark, root)
    return _state(spark, root, now["folders"] if now else []).select("day", "path", "rows", "bytes", "sha256").orderBy("day", "path")


def _relative(path):
    return F.concat(F.lit("year_month="), F.substring_index(path, "year_month=", -1))


def _files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)


def refresh(spark: SparkSession, root: str, expected_start: date, expected_end: date) -> dict:
    """Bring the catalog up to the store's files and return its last commit; without a change there is no new version.

    The listing opens no file. Its files that are new or changed are opened: those at least as young as the oldest of
    them are listed for reading, and the join leaves the others unread by the aggregate.
    """
    for _ in range(ATTEMPTS):
        now = latest(spark, root)
        version, folders = (now["version"], now["folders"]) if now else (0, [])
        known = _state(spark, root, folders)
        listed = _files(spark, root).select(_relative(F.col("path")).alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
        changed = listed.join(known.select("path", "bytes", "modified"), ["path", "bytes", "modified"], "left_anti")
        gone = known.join(listed.select("path"), "path", "left_anti")
        oldest = changed.agg(F.min("modified")).first()[0]
        if oldest is None and gone.limit(1).count() == 0 and now and (now["expected_start"], now["expected_end"]) == (str(expected_start), str(expected_end)):
            return now
        delta = gone.withColumn("version", F.lit(version + 1).cast("long")).withColumn("present", F.lit(False))
        if oldest is not None:
            young = F.col("modificationTime") >= F.lit(oldest)
            hashes = _files(spark, root).where(young).select(_relative(F.col("path")).alias("path"), F.sha2("content", 256).alias("sha256"))
            rows = read_store(spark, root).where(F.col("_metadata.file_modification_time") >= F.lit(oldest))
            rows = rows.groupBy(_relative(F.col("_metadata.file_path")).alias("path")).agg(F.count(F.lit(1)).alias("rows"))
            new = changed.join(hashes, "path").join(rows, "path", "left")
            day = F.regexp_extract("path", r"/day=(\d{4}-\d{2}-\d{2})/", 1)
            new = new.select("path", day.alias("day"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "bytes", "sha256", "modified", F.lit(version + 1).cast("long").alias("version"), F.lit(True).alias("present"))
            delta = delta.select(new.columns).unionByName(new)
        name = f"v{version + 1:012d}-{uuid.uuid4().hex}"
        delta.write.parquet(f"{root.rstrip('/')}/_catalog/log/{name}")
        added = spark.read.schema(RECORDS).parquet(f"{root.rstrip('/')}/_catalog/log/{name}")
        counts = added.agg(F.count(F.when(F.col("present"), 1)), F.countDistinct(F.when(F.col("present"), F.col("day"))), F.count(F.when(~F.col("present"), 1))).first()
        folders = [*folders, name]
        if len(folders) > COMPACT_AFTER:
            whole = f"v{version + 1:012d}-{uuid.uuid4().hex}"
            _state(spark, root, folders).select(delta.columns).write.parquet(f"{root.rstrip('/')}/_catalog/log/{whole}")
            folders = [whole]
        totals = _state(spark, root, folders).agg(F.countDistinct("day"), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        commit = {
            "version": version + 1, "folders": folders, "generated_at": datetime.now(timezone.utc).isoformat(), "expected_start": str(expected_start), "expected_end": str(expected_end),
            "n_partitions": totals[0], "total_rows": totals[1], "total_bytes": totals[2], "hashed_files": counts[0], "hashed_days": counts[1], "removed_files": counts[2],
        }
        if CommitFolder(spark, root).put(version + 1, json.dumps(commit)):
            return commit
    raise RuntimeError(f"the catalog of {root} changed {ATTEMPTS} times meanwhile")
