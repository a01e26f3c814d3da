"""Output presentation shared by every registered query.

Timestamps are rendered as ``yyyy-MM-dd HH:mm:ss`` text and doubles rounded
to a fixed number of decimals, so results compare across engines whose sum
order and timestamp units differ. The SQL twins apply the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMALS = 6


def present(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            # scaled rounding acts on the binary value, so engines agree on ties
            scale = float(10**decimals)
            c = F.round(c.cast("double") * F.lit(scale), 0) / F.lit(scale)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
