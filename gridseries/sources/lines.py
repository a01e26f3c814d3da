"""Raw daily files → canonical (cell, bin, measure) rows.

S1-S6, S16, F1, A1, P1-P4. Parsing works on any DataFrame of text lines,
so it is testable without files; :func:`read_lines` is the file scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import time as tf

# Field order of one raw line (TAB separated, no header).
SOURCE_COLUMNS = (
    "square_id",
    "time_interval",
    "country_code",
    "sms_in",
    "sms_out",
    "call_in",
    "call_out",
    "internet",
)
N_FIELDS = len(SOURCE_COLUMNS)

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("square_id", T.LongType(), False),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("internet", T.FloatType(), True),
    ]
)


def _day_file(path: Column) -> Column:
    """Name of the day file a path belongs to: its own name, or the folder ``file_name=<name>`` that holds its parts."""
    parts = F.split(path, "/")
    own, folder = F.element_at(parts, -1), F.regexp_replace(F.try_element_at(parts, F.lit(-2)), "^file_name=", "")
    return F.when(tf.date_from_filename(own).isNull() & tf.date_from_filename(folder).isNotNull(), folder).otherwise(own)


def discover_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Daily files whose name parses to a valid date, sorted by date.

    A day is one file, or a folder ``file_name=<day file name>`` of part files.
    Uses the binary-file listing with the ``content`` column pruned, so no
    file is read. Invalid calendar dates (month 13) give NULL and are dropped.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw_dir)
    files = listing.select("path", "length", _day_file(F.col("path")).alias("file_name"))
    return (
        files.withColumn("day", tf.date_from_filename(F.col("file_name")))
        .where(F.col("day").isNotNull())
        .select("day", "path", "file_name", F.col("length").alias("bytes"))
        .orderBy("day", "path")
    )


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Scan text files as (line, file_name); splits of large files run in parallel."""
    df = spark.read.text(paths)
    return df.select(F.col("value").alias("line"), _day_file(F.col("_metadata.file_path")).alias("file_name"))


def _fields(line: Column) -> Column:
    return F.split(line, "\t", -1)


def parsed_columns(lines: DataFrame, line_col: str = "line", max_id: int | None = None) -> DataFrame:
    """Split lines and type the three kept fields.

    Adds: ``_n`` field count, ``square_id`` bigint, ``time_interval`` bigint,
    ``internet`` double (empty string is the only NULL token) and
    ``_value_ok`` (every kept field parsed, the id is not negative and, if a
    ``max_id`` is configured, not above it).
    """
    f = _fields(F.col(line_col))
    raw_id = F.get(f, 0)
    raw_ms = F.get(f, 1)
    raw_net = F.get(f, 7)
    sid = F.expr("try_cast(get(split(`%s`, '\\t', -1), 0) AS BIGINT)" % line_col)
    ms = F.expr("try_cast(get(split(`%s`, '\\t', -1), 1) AS BIGINT)" % line_col)
    net = F.expr("try_cast(nullif(get(split(`%s`, '\\t', -1), 7), '') AS DOUBLE)" % line_col)
    ok = (
        sid.isNotNull()
        & (sid >= 0 if max_id is None else sid.between(0, max_id))
        & ms.isNotNull()
        & ((raw_net == "") | net.isNotNull())
    )
    return lines.select(
        "*",
        F.size(f).alias("_n"),
        sid.alias("square_id"),
        ms.alias("time_interval"),
        net.alias("internet"),
        F.coalesce(ok, F.lit(False)).alias("_value_ok"),
        raw_id.alias("_raw_id"),
        raw_ms.alias("_raw_ms"),
    )


def parse_lines(lines: DataFrame, on_bad_row: str = "fail", line_col: str = "line", max_id: int | None = None) -> DataFrame:
    """Well-formed, typed rows.

    Lines with a wrong field count are always skipped. A kept field that
    does not parse fails the job with ``on_bad_row="fail"`` (the original
    behaviour); with ``"skip"`` or ``"quarantine"`` the row is left out here
    and reported by :func:`bad_rows`.

    In skip / quarantine mode only the field count is a filter and the value
    checks are folded into the projected columns, so the line is split once
    per row (projection subexpressions are shared) instead of once per
    pushed-down predicate.
    """
    if on_bad_row not in ("fail", "skip", "quarantine"):
        raise ValueError(f"on_bad_row must be fail, skip or quarantine, not {on_bad_row!r}")
    p = parsed_columns(lines, line_col, max_id).where(F.col("_n") == N_FIELDS)
    ok = F.col("_value_ok")
    if on_bad_row == "fail":
        # a filter, so the check runs even when later steps prune the columns
        check = F.when(~ok, F.raise_error(F.concat(F.lit("unparseable raw line: "), F.col(line_col))))
        p = p.where(check.isNull())
    sid = F.when(ok, F.col("square_id"))
    keep = [c for c in lines.columns if c != line_col]
    out = p.select(
        sid.alias("square_id"),
        F.when(ok, F.col("time_interval")).alias("time_interval"),
        F.when(ok, F.col("internet")).alias("internet"),
        *keep,
    )
    return out if on_bad_row == "fail" else out.where(F.col("square_id").isNotNull())


def bad_rows(lines: DataFrame, line_col: str = "line", max_id: int | None = None) -> DataFrame:
    """Quarantine: lines dropped by parsing, with a reason (D3)."""
    p = parsed_columns(lines, line_col, max_id)
    reason = F.when(F.col("_n") != N_FIELDS, F.lit("field_count")).when(~F.col("_value_ok"), F.lit("bad_value"))
    keep = [c for c in lines.columns]
    return p.select(*keep, F.col("_n").alias("n_fields"), reason.alias("reason")).where(F.col("reason").isNotNull())


def canonicalise(parsed: DataFrame, tz: str = "Europe/Rome", session_tz: str = "UTC") -> DataFrame:
    """Drop NULL measures, sum over country per (file day, cell, bin), cast.

    ``ts`` is the instant of the epoch-ms bin. ``day`` / ``year_month``, the
    store's partition keys, are the date in the row's file name, so a file's rows
    are stored, skipped and replaced together even where one lies in a
    neighbour day; rows without a file date use their local date in ``tz``.
    """
    by_file = "file_name" in parsed.columns
    file_day = tf.date_from_filename(F.col("file_name")) if by_file else F.lit(None).cast("date")
    agg = (
        parsed.where(F.col("internet").isNotNull())
        .groupBy(file_day.alias("_file_day"), "square_id", "time_interval")
        .agg(F.sum("internet").alias("internet"))
    )
    ts = F.timestamp_millis(F.col("time_interval"))
    staged = agg.select("_file_day", "square_id", ts.alias("ts"), F.col("internet").cast("float").alias("internet"))
    local = F.convert_timezone(F.lit(session_tz), F.lit(tz), F.col("ts").cast("timestamp_ntz"))
    day = F.coalesce(F.col("_file_day"), F.to_date(local))
    return staged.withColumn("day", day).withColumn("year_month", tf.year_month_key(day)).drop("_file_day")


def to_canonical(df: DataFrame, tz: str = "Europe/Rome", session_tz: str = "UTC") -> DataFrame:
    """Cast a (square_id, ts, internet) table to the canonical schema.

    ``ts`` may be epoch milliseconds or a timestamp. A missing column raises
    ``ValueError`` listing the missing names.
    """
    missing = [c.name for c in CANONICAL_SCHEMA.fields if c.name not in df.columns]
    if missing:
        raise ValueError(f"canonical columns not found: {', '.join(missing)}")
    t = df.schema["ts"].dataType
    if isinstance(t, (T.LongType, T.IntegerType)):
        ts = F.timestamp_millis(F.col("ts"))
    elif isinstance(t, T.TimestampNTZType):
        ts = F.convert_timezone(F.lit(tz), F.lit(session_tz), F.col("ts")).cast("timestamp")
    else:
        ts = F.col("ts").cast("timestamp")
    return df.select(
        F.col("square_id").cast("long").alias("square_id"),
        ts.alias("ts"),
        F.col("internet").cast("float").alias("internet"),
    )


def ingest_profile(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Row reduction of one ingest in one aggregation (S16, re-aimed).

    raw_rows → well_formed_rows → parsed_rows → non_null_rows →
    canonical_rows, plus the reduction ratio canonical / raw. Malformed lines
    share a NULL key, which partial aggregation folds map-side.
    """
    p = parsed_columns(lines, line_col)
    wf = F.col("_n") == N_FIELDS
    good = wf & F.col("_value_ok")
    nn = good & F.col("internet").isNotNull()
    per_bin = p.groupBy(
        F.when(good, F.col("square_id")).alias("k1"), F.when(good, F.col("time_interval")).alias("k2")
    ).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(wf).alias("wf"),
        F.count_if(good).alias("ok"),
        F.count_if(nn).alias("nn"),
    )
    out = per_bin.agg(
        F.sum("raw").alias("raw_rows"),
        F.sum("wf").alias("well_formed_rows"),
        F.sum("ok").alias("parsed_rows"),
        F.sum("nn").alias("non_null_rows"),
        F.count_if((F.col("nn") > 0) & F.col("k1").isNotNull()).alias("canonical_rows"),
    )
    return out.withColumn(
        "reduction_ratio", F.try_divide(F.col("canonical_rows").cast("double"), F.col("raw_rows").cast("double"))
    )
