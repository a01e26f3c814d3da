"""Column functions for time handling.

All return ``Column`` expressions, so they stay inside whole-stage codegen.
Both ``timestamp`` (an instant) and ``timestamp_ntz`` (a wall-clock value)
columns are accepted; helpers that need to know which take the data type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: daily file name pattern of the raw archive.
FILENAME_REGEX = r"sms-call-internet-mi-(\d{4})-(\d{2})-(\d{2})\.txt$"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch; wall-clock epoch for ``timestamp_ntz``."""
    c = F.col(name)
    if is_ntz(df, name):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    return F.unix_micros(c)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch (as a bigint) for either timestamp type."""
    return F.floor(epoch_micros(df, name) / F.lit(1_000_000)).cast("bigint")


def bin_start(df: DataFrame, name: str, step_seconds: int) -> Column:
    """Floor a timestamp to a multiple of ``step_seconds`` since the epoch.

    Implemented with ``window`` so it works for both timestamp types and
    keeps the input type.
    """
    return F.window(F.col(name), f"{int(step_seconds)} seconds").start


def step_index(df: DataFrame, name: str, step_seconds: int, anchor: Column) -> Column:
    """floor((ts - anchor) / step) where ``anchor`` is an epoch-seconds column."""
    return F.floor((epoch_seconds(df, name) - anchor) / F.lit(int(step_seconds))).cast("bigint")


def wallclock(df: DataFrame, name: str, tz: str, session_tz: str) -> Column:
    """Local wall-clock time in ``tz`` as ``timestamp_ntz``.

    An instant is converted from the session zone into ``tz``; a
    ``timestamp_ntz`` column already is wall-clock time and is returned as is.
    """
    c = F.col(name)
    if is_ntz(df, name):
        return c
    return F.convert_timezone(F.lit(session_tz), F.lit(tz), c.cast("timestamp_ntz"))


def weekday_mon0(c: Column) -> Column:
    """Day of week, Monday = 0 .. Sunday = 6 (pandas ``dayofweek``)."""
    return F.weekday(c)


def slot_of_day(wall: Column, step_seconds: int) -> Column:
    """Bin index within the day: floor(seconds since midnight / step)."""
    secs = F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall).cast("int")
    return F.floor(secs / F.lit(int(step_seconds))).cast("int")


def date_from_filename(path: Column) -> Column:
    """Calendar date encoded in a daily file name; NULL for bad names or dates."""
    y = F.regexp_extract(path, FILENAME_REGEX, 1)
    m = F.regexp_extract(path, FILENAME_REGEX, 2)
    d = F.regexp_extract(path, FILENAME_REGEX, 3)
    txt = F.when(y != "", F.concat_ws("-", y, m, d))
    return F.try_to_date(txt, "yyyy-MM-dd")


def year_month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def partition_path(day: Column) -> Column:
    """Hive-style relative folder of one day in the store."""
    return F.concat(F.lit("year_month="), year_month_key(day), F.lit("/day="), F.date_format(day, "yyyy-MM-dd"))


def grid_row(square_id: Column, side: int) -> Column:
    """Row of a 1-based cell id on a ``side`` x ``side`` grid (bottom-up)."""
    return F.floor((square_id - 1) / F.lit(side)).cast("int")


def grid_col(square_id: Column, side: int) -> Column:
    return F.pmod(square_id - 1, F.lit(side)).cast("int")
