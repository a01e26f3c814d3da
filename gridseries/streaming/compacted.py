"""A table of bins that a stream keeps in a bounded number of folders (R2).

Every micro-batch adds one folder of partial sums and one commit, a small file that appears by a rename and names the
folders of the state. After ``keep`` of them the sums are merged by day into the base: only the days that they touch
are written again, so a day that the watermark has passed is never rewritten. Rows that come after the watermark are
kept apart and counted, in folders merged level by level. A folder is named by its batch, so a replay writes the same
ones, and a batch that has its commit is skipped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SeriesSpec
from ..functions import time as tf
from ..sources.catalog import CommitFolder

DAY = 86_400_000_000
EMPTY = {"newest": None, "rows": 0, "late_rows": 0, "deltas": [], "base": {}, "late": [], "retired": []}


def _state(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The last batch with a commit (-1 if none) and its state."""
    at = CommitFolder(spark, folder)
    versions = at.versions()
    return (versions[-1], at.read(versions[-1])) if versions else (-1, dict(EMPTY))


def _read(spark: SparkSession, folder: str, names: list[str], schema) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in names])


def _merged(sums: DataFrame, spec: SeriesSpec) -> DataFrame:
    return sums.groupBy(spec.entity, spec.ts, "_day").agg(F.sum(spec.value).alias(spec.value), F.sum("_n").alias("_n"), F.max("_u").alias("_u"))


def _base(state: dict, days: set[int] | None = None) -> list[str]:
    return [f"{name}/range={day}" for day, name in state["base"].items() if days is None or int(day) in days]


def _merge_late(spark: SparkSession, folder: str, late: list, epoch: int, schema, keep: int) -> list:
    """Merge a level's folders of late rows into one of the next level when there are ``keep`` of them."""
    level = 0
    while len(full := [n for at, n in late if at == level]) >= keep:
        name = f"late/{epoch}-{level + 1}"
        _read(spark, folder, full, schema).write.mode("overwrite").parquet(f"{folder}/{name}")
        late = [p for p in late if p[0] != level] + [[level + 1, name]]
        level += 1
    return late


def upsert_bins(stream: DataFrame, spec: SeriesSpec, entity: str, ts: str, value: str, folder: str, delay: int = 3600, keep: int = 8):
    """Sums per (entity, bin) of what the source holds by now, added to the table in ``folder``; returns the finished query.

    A row is late if its time is at or before the newest time of the batches before less ``delay`` seconds; it changes
    no bin and goes to :func:`late_rows`. Rows without a time or a value are left out, a null entity is an entity. There are at
    most ``keep`` folders of sums beside the base's, and ``keep`` folders of late rows a level. The driver holds
    the days of the base, one short text each. One query at a time writes a folder; a commit is refused if another did.
    """
    spark, folder = stream.sparkSession, folder.rstrip("/")
    micros = tf.epoch_micros(stream, ts).cast("long")
    rows = stream.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).withColumn("_u", micros)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        at = CommitFolder(spark, folder)
        last, state = _state(spark, folder)
        if epoch <= last:
            return
        late = F.lit(False) if state["newest"] is None else F.col("_u") <= state["newest"] - delay * 1_000_000
        start = tf.bin_start(batch, ts, spec.step)
        sums = (
            batch.where(~late).groupBy(F.col(entity).alias(spec.entity), start.alias(spec.ts))
            .agg(F.sum(value).cast("double").alias(spec.value), F.count(F.lit(1)).alias("_n"), F.max("_u").alias("_u"))
        )
        sums = sums.withColumn("_day", F.floor(tf.epoch_micros(sums, spec.ts) / DAY).cast("long"))
        schema = sums.schema
        delta = f"delta/{epoch}"
        sums.write.mode("overwrite").parquet(f"{folder}/{delta}")
        written = _read(spark, folder, [delta], schema).agg(F.sum("_n"), F.max("_u")).first()
        now = {**state, "deltas": [*state["deltas"], delta], "base": dict(state["base"]), "late": list(state["late"])}
        now["rows"] += written[0] or 0
        now["newest"] = max((t for t in (state["newest"], written[1]) if t is not None), default=None)
        if state["newest"] is not None:
            name = f"late/{epoch}-0"
            kept = batch.where(late).withColumn("_batch", F.lit(epoch).cast("long"))
            kept.write.mode("overwrite").parquet(f"{folder}/{name}")
            found = _read(spark, folder, [name], kept.schema).count()
            if found:
                now["late_rows"] += found
                now["late"] = _merge_late(spark, folder, [*now["late"], [0, name]], epoch, kept.schema, keep)
            else:
                at.fs.delete(at.path(f"{folder}/{name}"), True)
        if len(now["deltas"]) >= keep:
            fresh = _read(spark, folder, now["deltas"], schema)
            days = {r[0] for r in fresh.select("_day").distinct().collect()}
            parts = _merged(fresh.unionByName(_read(spark, folder, _base(state, days), schema)), spec)
            name = f"base/{epoch}"
            ranged = parts.withColumn("range", F.col("_day")).hint("rebalance", "range")
            ranged.sortWithinPartitions("range", spec.entity, spec.ts).write.mode("overwrite").partitionBy("range").parquet(f"{folder}/{name}")
            now["base"].update({str(day): name for day in days})
            now["deltas"] = []
        used = lambda s: {*s["deltas"], *_base(s), *(n for _, n in s["late"])}
        now["retired"] = sorted(used(state) - used(now))
        if not at.put(epoch, json.dumps(now)):
            raise RuntimeError(f"another query wrote batch {epoch} of {folder}")
        # a reader of the state before may still be at work: its folders go one batch later
        for name in state["retired"]:
            at.fs.delete(at.path(f"{folder}/{name}"), True)
        for version in at.versions()[:-2]:
            at.forget(version)

    q = rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{folder}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def read_bins(spark: SparkSession, folder: str, spec: SeriesSpec, entity_type: str, ts_type: str = "timestamp_ntz") -> DataFrame:
    """(entity, ts, value) of the table as of its last commit."""
    folder = folder.rstrip("/")
    _, state = _state(spark, folder)
    schema = f"`{spec.entity}` {entity_type}, `{spec.ts}` {ts_type}, `{spec.value}` double, _n bigint, _u bigint, _day bigint"
    parts = _read(spark, folder, state["deltas"], schema).unionByName(_read(spark, folder, _base(state), schema))
    return _merged(parts, spec).select(spec.entity, spec.ts, spec.value)


def late_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The late rows as they came, with their batch; ``schema`` is the stream's."""
    folder = folder.rstrip("/")
    _, state = _state(spark, folder)
    names = [n for _, n in state["late"]]
    fields = spark.createDataFrame([], schema).select("*", F.lit(None).cast("long").alias("_batch")).schema
    return _read(spark, folder, names, fields)
