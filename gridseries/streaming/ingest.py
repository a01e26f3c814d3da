"""Structured Streaming forms of ingest and online scoring.

Sinks and checkpoints live under a folder the caller passes, normally a
subfolder of the session's ``spark.checkpoint.dir`` (shared storage on a
cluster), so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import os
import uuid
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import SeriesSpec
from ..functions import time as tf
from ..sources.lines import bad_rows, canonicalise, parse_lines
from ..sources.store import write_quarantine, write_store


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    from ..session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- R1
def incremental_ingest(
    spark: SparkSession,
    raw_dir: str,
    store_root: str,
    checkpoint: str,
    tz: str = "Europe/Rome",
    on_bad_row: str = "fail",
    files_per_batch: int | None = None,
    max_id: int | None = None,
):
    """Ingest daily files not yet seen, then stop (trigger availableNow).

    The checkpoint records processed files, so a rerun only picks up new
    days (the skip-existing plan). Each micro-batch is canonicalised and
    written with dynamic partition overwrite, so a replayed batch rewrites
    the same days instead of duplicating them; bad lines go to the day's
    quarantine in the same way. A day must arrive in one batch: ``files_per_batch``
    (files per micro-batch, default unlimited) is for one file a day, and is refused for a
    folder a day, whose files a batch could part. Returns the finished query.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        if "file_name" in spark.read.text(raw_dir).columns:
            raise ValueError("files_per_batch would part the files of one day's folder")
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.load(raw_dir)
    # day files directly in the folder, or one folder per day file (file_name=<name>/part-*)
    name = F.col("file_name") if "file_name" in raw.columns else F.col("_metadata.file_name")
    lines = raw.select(F.col("value").alias("line"), name.alias("file_name")).where(
        tf.date_from_filename(F.col("file_name")).isNotNull()
    )
    session_tz = spark.conf.get("spark.sql.session.timeZone")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if on_bad_row == "quarantine":
            write_quarantine(bad_rows(batch, max_id=max_id), store_root)
        canon = canonicalise(parse_lines(batch, on_bad_row=on_bad_row, max_id=max_id), tz=tz, session_tz=session_tz)
        write_store(canon, store_root, mode="overwrite")

    q = (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


# ---------------------------------------------------------------- R2
def stream_bins(
    stream: DataFrame,
    spec: SeriesSpec,
    entity: str,
    ts: str,
    value: str,
    watermark: str = "1 hour",
) -> DataFrame:
    """Windowed sums per entity on an event stream (R2).

    Rows within the watermark delay update their window; a row older than the
    watermark of the previous micro-batch is dropped, and window state older
    than the watermark is released, so state stays bounded.
    """
    session_tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    ntz = tf.is_ntz(stream, ts)
    # watermarks need an instant: wall-clock values are read in the spec's zone
    et = F.convert_timezone(F.lit(spec.tz), F.lit(session_tz), F.col(ts)).cast("timestamp") if ntz else F.col(ts)
    agg = (
        stream.where(F.col(value).isNotNull())
        .withColumn("_et", et)
        .withWatermark("_et", watermark)
        .groupBy(F.window(F.col("_et"), f"{spec.step} seconds").alias("w"), F.col(entity).alias(spec.entity))
        .agg(F.sum(value).cast("double").alias(spec.value))
    )
    start = F.col("w.start")
    if ntz:
        start = F.convert_timezone(F.lit(session_tz), F.lit(spec.tz), start.cast("timestamp_ntz"))
    return agg.select(spec.entity, start.alias(spec.ts), spec.value)


def drain_upserts(stream_result: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """Run an update-mode aggregation to the end of a bounded source.

    Every micro-batch writes its updated rows into its own ``_batch=<id>``
    folder (overwritten if the batch is replayed after a failure, so replay
    never duplicates); the returned table keeps, per key, the row of the
    latest batch (an upsert sink without a table format).
    """
    out = os.path.join(folder, "rows")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"_batch={epoch_id}"))

    q = (
        stream_result.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", os.path.join(folder, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    spark = stream_result.sparkSession
    rows = spark.read.option("basePath", out).parquet(out)
    latest = rows.groupBy(*keys).agg(F.max("_batch").alias("_batch"))
    return rows.join(latest, keys + ["_batch"], "left_semi").drop("_batch")


# ---------------------------------------------------------------- R3
def online_forecasts(stream: DataFrame, spec: SeriesSpec, period: int, idle_ms: int | None = None) -> DataFrame:
    """Last-value and seasonal-naive forecast of each arriving row from per-key state.

    State per entity keeps only the values of the last ``period`` steps
    (bounded), so state grows with the number of entities, not with time;
    rows of one entity are expected in time order. With ``idle_ms`` the state of an
    entity that sent nothing for so long (processing time) is released.
    Output: (entity, ts, y_true, pred_last, pred_seasonal, abs_err_last,
    abs_err_seasonal).
    """
    ent = spec.entity
    lag = period * spec.step
    rows = stream.select(ent, spec.ts, spec.value, tf.epoch_seconds(stream, spec.ts).alias("_t"))
    ts_type = stream.schema[spec.ts].dataType.simpleString()
    ent_type = stream.schema[ent].dataType.simpleString()
    out_schema = (
        f"{ent} {ent_type}, {spec.ts} {ts_type}, y_true double, pred_last double, pred_seasonal double, "
        "abs_err_last double, abs_err_seasonal double"
    )
    state_schema = "hist_t array<bigint>, hist_v array<double>"

    def at_or_before(times: np.ndarray, values: np.ndarray, wanted: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """(found, value) of the last of the sorted rows at or before each wanted time, or exactly at it."""
        at = np.searchsorted(times, wanted, "right") - 1
        found = at >= 0
        at = np.maximum(at, 0)
        if exact:
            found &= times[at] == wanted
        return found, np.where(found, values[at], np.nan)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        parts = [p for p in pdfs if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).sort_values("_t", kind="mergesort")
        t = pdf["_t"].to_numpy(np.int64)
        y = pdf[spec.value].to_numpy(dtype=float, na_value=np.nan)
        past_t, past_v = (np.asarray(a) for a in state.get) if state.exists else (np.empty(0), np.empty(0))
        times = np.concatenate([past_t.astype(np.int64), t])
        values = np.concatenate([np.array([np.nan if v is None else v for v in past_v], float), y])
        order = np.argsort(times, kind="stable")  # of equal times the later row counts
        times, values = times[order], values[order]
        _, last = at_or_before(times, values, t - spec.step, exact=False)
        there, season = at_or_before(times, values, t - lag, exact=True)
        season = np.where(there, season, last)
        keep = times >= times[-1] - lag
        keep[:-1] &= times[1:] != times[:-1]
        state.update((times[keep].tolist(), [None if np.isnan(v) else v for v in values[keep].tolist()]))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(
            {
                ent: pdf[ent],
                spec.ts: pdf[spec.ts],
                "y_true": pdf[spec.value],
                "pred_last": last,
                "pred_seasonal": season,
                "abs_err_last": np.abs(y - last),
                "abs_err_seasonal": np.abs(y - season),
            }
        )

    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return rows.groupBy(ent).applyInPandasWithState(fn, out_schema, state_schema, "append", timeout)
