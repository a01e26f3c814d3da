"""Online forecasts of rows that may arrive out of order.

``transformWithState`` keeps, for each entity, the rows of the last season and those that still wait for the
watermark, in a map of time buckets one season long. An event-time timer at the earliest waiting row fires once no
earlier row can come; the rows that are complete are then answered in time order. So the result does not depend on
the order of arrival within the watermark, and a task holds two buckets at a time, however many rows wait.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import SeriesSpec
from ..functions import time as tf

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def values_at(times: np.ndarray, values: np.ndarray, wanted: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(found, value) of the last of the sorted rows at or before each wanted time, or exactly at it."""
    if not len(times):
        return np.zeros(len(wanted), bool), np.full(len(wanted), np.nan)
    at = np.searchsorted(times, wanted, "right") - 1
    found = at >= 0
    at = np.maximum(at, 0)
    if exact:
        found &= times[at] == wanted
    return found, np.where(found, values[at], np.nan)


def one_row_a_time(times: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by time; of several at one time the greatest value, a missing one last of all."""
    order = np.lexsort((np.where(np.isnan(values), -np.inf, values), ~np.isnan(values), times))
    times, values = times[order], values[order]
    last = np.ones(len(times), bool)
    last[:-1] = times[1:] != times[:-1]
    return times[last], values[last]


class OrderedForecasts(StatefulProcessor):
    """State and timers of one entity; times are microseconds."""

    def __init__(self, step: int, period: int, idle: int | None):
        self.step, self.season, self.idle = step * 1_000_000, period * step * 1_000_000, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "bucket bigint", "at array<bigint>, v array<double>")
        # answered up to, earliest waiting row, newest row, and the last row before the kept buckets
        self.front = handle.getValueState("front", "done bigint, waiting bigint, newest bigint, carry_at bigint, carry_v double")

    def _front(self) -> list:
        return list(self.front.get()) if self.front.exists() else [None, None, None, None, None]

    def _bucket(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        at, v = self.buckets.getValue((number,))
        return np.array(at, np.int64), np.array(v, float)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, waiting, newest, *carry = self._front()
        for pdf in rows:
            at, v = one_row_a_time(pdf["micros"].to_numpy(np.int64), pdf["y_true"].to_numpy(dtype=float, na_value=np.nan))
            if done is not None:  # these were answered; Spark's own filter of late rows holds them back before
                at, v = at[at > done], v[at > done]
            if not len(at):
                continue
            numbers = at // self.season
            for number in np.unique(numbers):
                lo, hi = np.searchsorted(numbers, [number, number + 1])
                more_at, more_v = at[lo:hi], v[lo:hi]
                if self.buckets.containsKey((int(number),)):
                    old_at, old_v = self._bucket(int(number))
                    more_at, more_v = one_row_a_time(np.concatenate([old_at, more_at]), np.concatenate([old_v, more_v]))
                self.buckets.updateValue((int(number),), (more_at.tolist(), more_v.tolist()))
            waiting = int(at[0]) if waiting is None else min(waiting, int(at[0]))
            newest = int(at[-1]) if newest is None else max(newest, int(at[-1]))
        if waiting is not None:
            self.front.update((done, waiting, newest, *carry))
            self.handle.registerTimer(-(-waiting // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done, waiting, newest, carry_at, carry_v = self._front()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        if newest is None:
            return
        if waiting is not None and waiting <= now:
            before = (np.empty(0, np.int64), np.empty(0)) if carry_at is None else (np.array([carry_at]), np.array([carry_v], float))
            waiting = None
            for number in sorted(k[0] for k in self.buckets.keys()):
                if number * self.season > now:
                    waiting = int(self._bucket(number)[0][0])
                    break
                at, v = self._bucket(number)
                times, values = np.concatenate([before[0], at]), np.concatenate([before[1], v])
                ready = at <= now if done is None else (at <= now) & (at > done)
                if ready.any():
                    there, last = values_at(times, values, at[ready] - self.step, exact=False)
                    same, season = values_at(times, values, at[ready] - self.season, exact=True)
                    yield pd.DataFrame({"entity": pd.Series([key[0]] * int(ready.sum()), dtype=object), "micros": at[ready], "y_true": v[ready], "pred_last": last, "pred_seasonal": np.where(same, season, last)})
                # the next bucket's rows look back at this one, and at the last row before it
                before = np.concatenate([before[0][-1:], at]), np.concatenate([before[1][-1:], v])
                if number < now // self.season - 1:
                    carry_at, carry_v = int(at[-1]), float(v[-1])
                    self.buckets.removeKey((number,))
                if (at > now).any():
                    waiting = int(at[at > now][0])
                    break
            done = now
            self.front.update((done, waiting, newest, carry_at, carry_v))
        if waiting is not None:
            self.handle.registerTimer(-(-waiting // 1000))
        elif self.idle is not None:
            if now >= newest + self.idle * 1_000_000:
                self.buckets.clear()
                self.front.clear()
            else:
                self.handle.registerTimer(-(-newest // 1000) + self.idle * 1000)

    def close(self) -> None:
        return None


def ordered_forecasts(stream: DataFrame, spec: SeriesSpec, period: int, delay: str = "1 hour", idle: int | None = None) -> DataFrame:
    """Last-value and seasonal forecasts of each row, as of the rows before it in time and not in arrival.

    (entity, ts, y_true, pred_last, pred_seasonal, abs_err_last, abs_err_seasonal). A row is answered once the
    watermark, ``delay`` behind the newest row of all entities, has passed it; a bounded stream is closed by any row
    later than all others by more than ``delay``, which itself stays unanswered. Rows at or before the watermark
    when they arrive are dropped and counted by Spark (``numRowsDroppedByWatermark``). A time holds one value: of
    rows with equal times the greatest counts, a missing value only if there is no other. Rows without a time are
    never answered; a null entity is an entity. With ``idle`` seconds of event time without a row an entity's state is released.
    Needs the RocksDB state store (:func:`drain`).
    """
    e, ts = spec.entity, spec.ts
    micros = tf.epoch_micros(stream, ts).cast("long")
    # plain names, which the row frames keep; the key as text, whose missing value equals itself there
    rows = stream.where(F.col(ts).isNotNull()).select(F.col(e).cast("string").alias("entity"), F.col(spec.value).cast("double").alias("y_true"), micros.alias("micros"))
    rows = rows.withColumn("event_time", F.timestamp_micros("micros")).withWatermark("event_time", delay)
    model = OrderedForecasts(spec.step, period, idle)
    schema = "entity string, micros bigint, y_true double, pred_last double, pred_seasonal double"
    out = rows.groupBy("entity").transformWithStateInPandas(model, outputStructType=schema, outputMode="append", timeMode="EventTime")
    back = F.expr("timestampadd(MICROSECOND, micros, TIMESTAMP_NTZ'1970-01-01 00:00:00')") if tf.is_ntz(stream, ts) else F.timestamp_micros("micros")
    error = lambda c: F.abs(F.col("y_true") - F.col(c))
    entity = F.col("entity").cast(stream.schema[e].dataType).alias(e)
    return out.select(entity, back.alias(ts), "y_true", "pred_last", "pred_seasonal", error("pred_last").alias("abs_err_last"), error("pred_seasonal").alias("abs_err_seasonal"))


def drain(result: DataFrame, folder: str) -> DataFrame:
    """Answer what the source holds by now, stop, and return all rows written below ``folder`` so far; the next call goes on from there.

    The state store provider is set for this query only.
    """
    spark = result.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = (
            result.writeStream.outputMode("append").format("parquet")
            .option("path", os.path.join(folder, "rows")).option("checkpointLocation", os.path.join(folder, "checkpoint"))
            .trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    q.awaitTermination()
    return spark.read.schema(result.schema).parquet(os.path.join(folder, "rows"))
