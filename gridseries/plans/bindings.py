"""Binding of operator inputs to the driver's tables.

| input                         | built from                                             |
|-------------------------------|--------------------------------------------------------|
| hourly series                 | events by event_type, 1-hour bins, sum(value)          |
| cells / totals / grid         | events by user_id                                      |
| raw lines                     | one 8-field tab-separated line per event               |
| daily series                  | orders by o_orderpriority, sum(o_totalprice) per day   |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datetime import datetime

from ..config import DAILY, EVENTS_SPLIT, HOURLY, SeriesSpec, Split
from ..operators.series import binned

EVENTS_HOURLY: SeriesSpec = HOURLY.with_(entity="event_type")
EVENTS_CELLS: SeriesSpec = HOURLY.with_(entity="user_id")
EVENTS_10MIN: SeriesSpec = SeriesSpec(entity="square_id", ts="ts", value="internet", step=600, daily=144, weekly=1008, tz="UTC")
ORDERS_DAILY: SeriesSpec = DAILY.with_(entity="o_orderpriority")
SPLIT = EVENTS_SPLIT
# Daily order totals: the last five months are the test window.
ORDERS_SPLIT = Split(
    train_start=datetime(1995, 1, 1),
    train_end=datetime(2000, 12, 31),
    val_start=datetime(2001, 1, 1),
    val_end=datetime(2001, 2, 28),
    test_start=datetime(2001, 3, 1),
    test_end=datetime(2001, 8, 1),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, ts, value): hourly sums per event type."""
    return binned(events(spark, sf_dir), EVENTS_HOURLY, "event_type", "ts", "value")


def cells_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, ts, value): hourly sums per user, the 'grid cell' binding."""
    return binned(events(spark, sf_dir), EVENTS_CELLS, "user_id", "ts", "value")


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binned(table(spark, sf_dir, "orders"), ORDERS_DAILY, "o_orderpriority", "o_orderdate", "o_totalprice")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily-file lines derived from events (M1 layout, 8 TAB fields).

    Every event is a line: square_id = user_id, time_interval = epoch ms of the
    10-minute bin, country_code = length of the event type, three activity fields
    empty, call_out = event_id, internet = value, in the file of its calendar day. Added
    to these, from the same events and so in proportion to them:

    * error events: a line with the null token for internet;
    * signup events: a line of cell user_id + 70000 (an id beyond 16 bits);
    * purchase events: the line again in the file of the day before (a spill row);
    * every tenth event id: a line of two fields and one whose id is no number.
    """
    ev = events(spark, sf_dir)
    bin_ms = (
        F.floor(F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / 600) * 600000
    ).cast("bigint")

    def line(square_id, internet):
        fields = [
            square_id.cast("string"), bin_ms.cast("string"), F.length("event_type").cast("string"),
            F.lit(""), F.lit(""), F.lit(""), F.col("event_id").cast("string"), internet.cast("string"),
        ]
        # concat_ws skips NULLs, which would shift fields: NULL becomes the empty token
        return F.concat_ws("\t", *[F.coalesce(f, F.lit("")) for f in fields])

    uid, value, null = F.col("user_id"), F.col("value"), F.lit(None).cast("double")
    tenth = F.col("event_id") % 10 == 0
    lines = F.array(
        F.struct(line(uid, value).alias("line"), F.lit(0).alias("back")),
        F.when(F.col("event_type") == "error", F.struct(line(uid, null).alias("line"), F.lit(0).alias("back"))),
        F.when(F.col("event_type") == "signup", F.struct(line(uid + 70000, value).alias("line"), F.lit(0).alias("back"))),
        F.when(F.col("event_type") == "purchase", F.struct(line(uid, value).alias("line"), F.lit(1).alias("back"))),
        F.when(tenth, F.struct(F.concat_ws("\t", uid.cast("string"), bin_ms.cast("string")).alias("line"), F.lit(0).alias("back"))),
        F.when(tenth, F.struct(line(F.concat(F.lit("x"), uid.cast("string")), value).alias("line"), F.lit(0).alias("back"))),
    )
    rows = ev.select(F.to_date("ts").alias("day"), F.explode(lines).alias("l")).where("l IS NOT NULL")
    day = F.date_format(F.date_sub("day", F.col("l.back")), "yyyy-MM-dd")
    return rows.select("l.line", F.concat(F.lit("sms-call-internet-mi-"), day, F.lit(".txt")).alias("file_name"))


_LINE_FOLDERS: dict[tuple[str, str], str] = {}


def raw_line_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the raw lines as text files, written once per application and table folder.

    It lies in the shared checkpoint folder, with one sub-folder per daily file
    name (``file_name=sms-call-internet-mi-YYYY-MM-DD.txt``).
    """
    from ..streaming.ingest import scratch

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LINE_FOLDERS:
        folder = scratch(spark, "raw-lines")
        raw_lines(spark, sf_dir).write.partitionBy("file_name").text(folder)
        _LINE_FOLDERS[key] = folder
    return _LINE_FOLDERS[key]


def raw_line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines scanned back the way ingest reads them: (line, file_name)."""
    df = spark.read.text(raw_line_folder(spark, sf_dir))
    return df.select(F.col("value").alias("line"), "file_name")
