"""Run logs, summary merges and report writers.

Writers take a target folder; on a cluster that is the shared store, never
a machine-local path.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = (
    "model string, square_id bigint, train_seconds double, train_steps bigint, "
    "predict_seconds_total double, predict_seconds_per_step_mean double, test_steps bigint"
)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], merge_columns: bool = True) -> DataFrame:
    """Replace rows of ``old`` whose key appears in ``new``; append the rest.

    With ``merge_columns`` a replaced row keeps values for columns only the
    old row had (the original tool lost them); otherwise the old row is
    dropped whole (left_anti + union).
    """
    keys = list(keys)
    if not merge_columns:
        kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
        return kept.unionByName(new, allowMissingColumns=True)
    cols = list(dict.fromkeys(list(old.columns) + list(new.columns)))
    o = old.select(*[F.col(c).alias(f"_o_{c}") if c not in keys else F.col(c) for c in old.columns])
    n = new.select(*[F.col(c).alias(f"_n_{c}") if c not in keys else F.col(c) for c in new.columns]).withColumn("_in_new", F.lit(True))
    j = o.join(n, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in new.columns and c in old.columns:
            # new wins for keys present in the batch, even when its value is NULL
            out.append(F.when(F.col("_in_new"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
        elif c in new.columns:
            out.append(F.col(f"_n_{c}").alias(c))
        else:
            out.append(F.col(f"_o_{c}").alias(c))
    return j.select(*out)


def merge_summary(previous: DataFrame, current: DataFrame, key: str = "square_id") -> DataFrame:
    """Per-entity summary merge: current rows win, previous-only entities and columns stay."""
    return upsert(previous, current, [key], merge_columns=True).select(
        key, *[c for c in current.columns if c != key], *[c for c in previous.columns if c not in current.columns]
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def replace_folder(spark: SparkSession, write, path: str) -> None:
    """Call ``write(folder)`` on a folder beside ``path``, then put it in the place of ``path``."""
    import uuid

    fresh, old = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    write(fresh)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(hadoop(path))
    if had:
        fs.rename(hadoop(path), hadoop(old))
    if not fs.rename(hadoop(fresh), hadoop(path)):
        raise OSError(f"cannot rename {fresh} to {path}")
    if had:
        fs.delete(hadoop(old), True)


def read_json_summary(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read a JSON summary; corrupt records are dropped, an absent path is empty.

    Any other failure is raised: a store that cannot be read now is not an empty one.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema) if schema else spark.createDataFrame([], "x string").limit(0)
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if schema:
        reader = reader.schema(schema + ", _corrupt_record string")
    df = reader.json(path)
    if "_corrupt_record" in df.columns:
        df = df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return df


def read_run_log(spark: SparkSession, path: str, schema: str = RUN_LOG_SCHEMA) -> DataFrame:
    """Timing history CSV with header."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_run_log(df: DataFrame, path: str) -> None:
    """Run log CSV (K11); one file, the table is one row per (model, entity)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_forecasts(forecasts: DataFrame, root: str, entity: str) -> None:
    """Forecast table, a folder per model, files sorted by entity (K4).

    Dynamic overwrite, for this write only, replaces the models being written.
    Adaptive execution splits a large model over several files, whose row-group
    statistics find an entity.
    """
    (
        forecasts.hint("rebalance", "model")
        .sortWithinPartitions("model", entity)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model")
        .parquet(root)
    )


def read_forecasts(spark: SparkSession, root: str, requested: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """Forecasts for the requested (model, entity) pairs and the pairs that are absent."""
    f = spark.read.parquet(root)
    f = f.withColumn(entity, F.col(entity).cast(requested.schema[entity].dataType))
    have = f.select("model", entity).distinct()
    missing = requested.join(have, ["model", entity], "left_anti")
    return f.join(requested.select("model", entity).distinct(), ["model", entity], "left_semi"), missing


def write_partitioned_csv(df: DataFrame, path: str, by: str) -> None:
    """Metrics / anomaly tables as CSV with header, one folder per entity (K5, K6); folders of entities no longer there go."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True).partitionBy(by).csv(path)


def markdown_table(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pipe-table lines of a report, header first, rows in ``order`` (K8).

    The ordering is a distributed range sort (no single-task window), and the
    text writer keeps it across part files.
    """
    head = "| " + " | ".join(columns) + " |"
    rule = "|" + "|".join(["---"] * len(columns)) + "|"
    body = df.select(
        F.lit(2).alias("_k"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns]), F.lit(" |")).alias("line"),
    )
    spark = df.sparkSession
    hdr = spark.createDataFrame([(0, head), (1, rule)], "_k int, line string")
    for i, c in enumerate(order):
        hdr = hdr.withColumn(f"_o{i}", F.lit(None).cast(df.schema[c].dataType))
    keys = ["_k"] + [f"_o{i}" for i in range(len(order))]
    return hdr.unionByName(body).orderBy(*keys).select("line")


def write_text(df: DataFrame, path: str) -> None:
    """One-column text output, e.g. the top-area file (K9)."""
    df.coalesce(1).write.mode("overwrite").text(path)
