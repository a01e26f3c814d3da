"""Small DataFrame helpers shared by operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row global aggregate to every row of ``df``.

    The aggregate becomes one uncorrelated scalar subquery (a struct of all
    its columns, evaluated once per query and reused), so there is no join,
    broadcast or cross product at all.
    """
    packed = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_s")).scalar()
    # one reference to the subquery; fields are read from the projected struct
    staged = df.withColumn("_scalars", packed)
    return staged.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_scalars").getField(c).alias(c) for c in one_row.columns])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the session's shared checkpoint folder and read it again.

    For a table that several branches read: it is computed once, survives the
    loss of an executor, and holds no executor memory or disk.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
