"""The ingest command as one function."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IngestConfig
from ..operators import reporting as rep
from ..sources import catalog as cat
from ..sources import lines as ln
from ..sources import store as st


def _store_exists(spark: SparkSession, root: str) -> bool:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(path))


def _drop_quarantine(spark: SparkSession, root: str, days: list) -> None:
    """Forget the bad lines of days that are about to be read again, so a mended file leaves none behind."""
    jvm = spark._jvm
    for day in days:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{st.QUARANTINE}/day={day:%Y-%m-%d}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_ingest(
    spark: SparkSession,
    raw_dir: str,
    store_root: str,
    cfg: IngestConfig = IngestConfig(),
    force: bool = False,
    limit_days: int = 0,
) -> dict[str, DataFrame]:
    """Discover daily files, ingest the ones not yet stored, bring the catalog up to date (new files only).

    A file's rows go to its own day's folder and its bad lines to that day's
    quarantine, so stored rows plus quarantined lines are all lines, over any number of
    runs. Only the file listing (one row per day file) is brought to the
    driver, to hand the chosen paths to the text scan; rows never are. Returns the
    catalog DataFrames: plan, partitions, manifest, missing, quarantine (all lines kept so far).
    """
    files = ln.discover_files(spark, raw_dir)
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"no daily file below {raw_dir}")
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    stored = st.list_partitions(spark, store_root) if _store_exists(spark, store_root) else spark.createDataFrame([], "day date")
    plan = st.incremental_plan(files, stored, force=force, limit_days=limit_days)
    todo = plan.select("day", "path").collect()
    if todo:
        lines = ln.read_lines(spark, [r.path for r in todo])
        if cfg.on_bad_row == "quarantine":
            _drop_quarantine(spark, store_root, [r.day for r in todo])
            st.write_quarantine(ln.bad_rows(lines, max_id=cfg.max_square_id), store_root)
        parsed = ln.parse_lines(lines, on_bad_row=cfg.on_bad_row, max_id=cfg.max_square_id)
        st.write_store(ln.canonicalise(parsed, tz=cfg.tz, session_tz=session_tz), store_root, compression=cfg.compression)
    kept = _store_exists(spark, os.path.join(store_root, st.QUARANTINE))
    empty = "line string, file_name string, n_fields int, reason string, day date"
    quarantine = st.read_quarantine(spark, store_root) if kept else spark.createDataFrame([], empty)
    bounds = files.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    first = date.fromisoformat(cfg.expected_first_date) if cfg.expected_first_date else bounds["lo"]
    last = date.fromisoformat(cfg.expected_last_date) if cfg.expected_last_date else bounds["hi"]
    commit = cat.refresh(spark, store_root, first, last)
    records = cat.records(spark, store_root)
    manifest = cat.commits(spark, store_root).where(F.col("version") == commit["version"])
    dated = [F.col(c).cast("date").alias(c) for c in ("expected_start", "expected_end")]
    manifest = manifest.select("generated_at", *dated, "n_partitions", "total_rows", "total_bytes", "version")
    missing = st.missing_days(records.select(F.col("day").cast("date").alias("day")), first, last)
    # one line per missing day: a list of any length, never gathered into one row; readers see the old list or the new one
    lines = missing.select(F.date_format("day", "yyyy-MM-dd").alias("missing_date"))
    rep.replace_folder(spark, lambda to: lines.write.json(to), os.path.join(store_root, "_catalog", "missing"))
    return {"plan": plan, "partitions": records, "manifest": manifest, "missing": missing, "quarantine": quarantine}
