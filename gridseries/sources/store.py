"""The partitioned Parquet store and its catalog.

S7 S10-S12 K1-K3 J1 J2 T6 T7 U2. Partition keys are real directory keys
(``year_month=YYYY-MM/day=YYYY-MM-DD``), so a time-bounded read prunes
partitions instead of opening every file.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import CANONICAL_SCHEMA

STORE_SCHEMA = "square_id bigint, ts timestamp, internet float, year_month string, day date"


def write_store(
    canonical: DataFrame,
    root: str,
    compression: str = "snappy",
    rows_per_file: int = 2_000_000,
    mode: str = "overwrite",
) -> None:
    """Write canonical rows partitioned by (year_month, day).

    Rows are rebalanced by day: adaptive execution splits a day that holds a
    large share of the data over several tasks and joins small days, so neither a
    count nor a cached copy is needed. Every file is sorted by (square_id, ts), so
    Parquet min/max statistics skip row groups on cell / time filters. Dynamic
    partition overwrite, set for this write only, replaces only the days being
    written, and the output committer gives task/job atomicity in place of
    tmp-then-rename.
    """
    (
        canonical.hint("rebalance", "day")
        # the partition columns first: another order would be sorted away by the writer
        .sortWithinPartitions("year_month", "day", "square_id", "ts")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("parquet.enable.dictionary", "false")
        .option("parquet.block.size", str(32 * 1024 * 1024))
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("year_month", "day")
        .parquet(root)
    )


QUARANTINE = "_quarantine"


def write_quarantine(bad: DataFrame, root: str, file_col: str = "file_name") -> None:
    """Bad lines below the store, a folder for each file day (D3).

    A day written again replaces its own lines and no other's; lines of files
    without a date share the folder of a NULL day.
    """
    from ..functions import time as tf

    (
        bad.withColumn("day", tf.date_from_filename(F.col(file_col)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(f"{root.rstrip('/')}/{QUARANTINE}")
    )


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """All bad lines kept so far: (line, file_name, n_fields, reason, day)."""
    schema = "line string, file_name string, n_fields int, reason string, day date"
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{QUARANTINE}")


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The store as one DataFrame with an explicit schema."""
    return spark.read.schema(STORE_SCHEMA).parquet(root)


def day_filter(start: date | None, end: date | None):
    """Partition predicate on ``day`` for a local-date range (pruning)."""
    c = F.lit(True)
    if start is not None:
        c = c & (F.col("day") >= F.lit(start))
    if end is not None:
        c = c & (F.col("day") <= F.lit(end))
    return c


def list_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Stored days, sorted (S10, T7): from the listing of the files, none of which is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select("path")
    )
    key = r"/year_month=([^/]+)/day=(\d{4}-\d{2}-\d{2})/[^/]+$"
    found = files.select(F.regexp_extract("path", key, 1).alias("year_month"), F.regexp_extract("path", key, 2).alias("day"))
    return found.where("day <> ''").select("year_month", F.col("day").cast("date").alias("day")).distinct().orderBy("day")


def has_partition(spark: SparkSession, root: str, day: date) -> bool:
    return read_store(spark, root).where(F.col("day") == F.lit(day)).limit(1).count() > 0


def file_checksums(spark: SparkSession, root: str) -> DataFrame:
    """sha256 and size of each Parquet file under ``root``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", F.col("length").alias("bytes"), F.sha2(F.col("content"), 256).alias("sha256"))
    )


def profile_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Per file: day, relative path, rows, bytes, sha256.

    Row counts come from a metadata-only scan grouped by file path; the
    checksum join is on the file path.
    """
    rows = (
        read_store(spark, root)
        .select("day", F.col("_metadata.file_path").alias("path"))
        .groupBy("day", "path")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    sums = file_checksums(spark, root)
    rel = F.concat(F.lit("year_month="), F.substring_index(F.col("path"), "year_month=", -1))
    return (
        rows.join(sums, "path", "left")
        .select(F.date_format("day", "yyyy-MM-dd").alias("day"), rel.alias("path"), "rows", "bytes", "sha256")
        .orderBy("day", "path")
    )


def manifest(records: DataFrame, expected_start: date, expected_end: date) -> DataFrame:
    """Manifest totals row (K2, A16): partitions, rows and bytes."""
    return records.agg(
        F.current_timestamp().alias("generated_at"),
        F.lit(expected_start).alias("expected_start"),
        F.lit(expected_end).alias("expected_end"),
        F.countDistinct("day").alias("n_partitions"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )


def missing_days(present: DataFrame, start=None, end=None) -> DataFrame:
    """Days of the expected calendar with no data.

    Without explicit bounds the calendar spans the first..last present day,
    so leading and trailing gaps are invisible, as in the original.
    """
    days = present.select(F.col("day").cast("date").alias("day"))
    if start is None or end is None:
        bounds = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    else:
        bounds = days.sparkSession.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    cal = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return cal.join(days.distinct(), "day", "left_anti")


def incremental_plan(files: DataFrame, stored: DataFrame, force: bool = False, limit_days: int = 0) -> DataFrame:
    """Files still to ingest: not stored (unless ``force``), those of the first N days."""
    todo = files if force else files.join(stored.select("day").distinct(), "day", "left_anti")
    if limit_days > 0:
        first = todo.select("day").distinct().orderBy("day").limit(limit_days)
        todo = todo.join(first, "day", "left_semi")
    return todo.orderBy("day", "path")


__all__ = [
    "CANONICAL_SCHEMA",
    "write_store",
    "write_quarantine",
    "read_quarantine",
    "read_store",
    "day_filter",
    "list_partitions",
    "has_partition",
    "file_checksums",
    "profile_partitions",
    "manifest",
    "missing_days",
    "incremental_plan",
]


def load_series(
    spark: SparkSession,
    root: str,
    ids=None,
    start=None,
    end=None,
    tz: str = "Europe/Rome",
) -> DataFrame:
    """Cells' series from the store with cell, time and partition filters.

    Naive bounds are local wall-clock times in ``tz``. Besides the exact
    ``ts`` bounds, a ``day`` partition predicate is derived from them, one day
    wider on either side since a folder holds what its day's file held, so only those
    folders are listed and read; the cell filter reaches the Parquet reader, where the
    (square_id, ts) sort order lets row-group statistics skip data. Duplicates are kept.
    """
    from ..operators.series import ts_literal

    def local_day(bound: datetime) -> date:
        return (bound.astimezone(ZoneInfo(tz)) if bound.tzinfo else bound).date()

    df = read_store(spark, root)
    cond = F.lit(True)
    if ids is not None:
        ids = list(ids) if not isinstance(ids, (int, str)) else [ids]
        cond = cond & F.col("square_id").isin(ids)
    if start is not None:
        cond = cond & (F.col("ts") >= ts_literal(df, "ts", start, tz)) & (F.col("day") >= F.lit(local_day(start) - timedelta(days=1)))
    if end is not None:
        cond = cond & (F.col("ts") <= ts_literal(df, "ts", end, tz)) & (F.col("day") <= F.lit(local_day(end) + timedelta(days=1)))
    return df.where(cond).select("square_id", "ts", "internet", "day")
