from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridseries.sources import lines as ln

# F1 literal raw lines (tab separated).
GOOD = [
    "5161\t1383260400000\t39\t1.0\t\t\t\t2.5",
    "5161\t1383260400000\t33\t\t\t\t\t1.5",
    "5161\t1383261000000\t39\t\t\t\t\t",
    "42\t1383261000000\t39\t\t\t\t\t7.0",
]
SHORT = "1\t2\t3"
LONG = "1\t2\t3\t4\t5\t6\t7\t8\t9"
BAD_ID = "abc\t1383260400000\t39\t\t\t\t\t1.0"


def _lines(spark, items):
    return spark.createDataFrame([(x, "sms-call-internet-mi-2013-11-01.txt") for x in items], "line string, file_name string")


def test_canonical_sums_countries_and_drops_nulls(spark):
    parsed = ln.parse_lines(_lines(spark, GOOD + [SHORT, LONG]), on_bad_row="fail")
    canon = ln.canonicalise(parsed, tz="Europe/Rome", session_tz="UTC")
    got = sorted((r.square_id, r.internet) for r in canon.collect())
    assert got == [(42, 7.0), (5161, 4.0)]
    assert dict(canon.dtypes)["internet"] == "float"
    assert dict(canon.dtypes)["square_id"] == "bigint"


def test_epoch_is_local_midnight_in_rome(spark):
    parsed = ln.parse_lines(_lines(spark, GOOD[:1]))
    c = ln.canonicalise(parsed, tz="Europe/Rome", session_tz="UTC").first()
    assert c.day == date(2013, 11, 1)
    assert c.year_month == "2013-11"
    wall = ln.canonicalise(parsed, tz="Europe/Rome", session_tz="UTC").select(
        F.convert_timezone(F.lit("UTC"), F.lit("Europe/Rome"), F.col("ts").cast("timestamp_ntz")).alias("w")
    ).first().w
    assert wall == datetime(2013, 11, 1, 0, 0)


def test_bad_value_fails_or_quarantines(spark):
    lines = _lines(spark, GOOD + [BAD_ID, SHORT])
    with pytest.raises(Exception):
        ln.parse_lines(lines, on_bad_row="fail").count()
    kept = ln.parse_lines(lines, on_bad_row="quarantine")
    assert kept.count() == 4
    bad = sorted((r.line, r.reason) for r in ln.bad_rows(lines).collect())
    assert bad == [(SHORT, "field_count"), (BAD_ID, "bad_value")]


def test_empty_input_gives_empty_canonical(spark):
    canon = ln.canonicalise(ln.parse_lines(_lines(spark, [])))
    assert canon.count() == 0
    assert [c for c, _ in canon.dtypes][:3] == ["square_id", "ts", "internet"]


def test_to_canonical_checks_columns(spark):
    df = spark.createDataFrame([(1, 1383260400000)], "square_id int, ts bigint")
    with pytest.raises(ValueError, match="internet"):
        ln.to_canonical(df)
    ok = ln.to_canonical(spark.createDataFrame([(1, 1383260400000, 2.5)], "square_id long, ts bigint, internet double"))
    assert dict(ok.dtypes) == {"square_id": "bigint", "ts": "timestamp", "internet": "float"}


def test_ingest_profile(spark):
    p = ln.ingest_profile(_lines(spark, GOOD + [SHORT, LONG, BAD_ID])).first()
    assert (p.raw_rows, p.well_formed_rows, p.parsed_rows, p.non_null_rows, p.canonical_rows) == (7, 5, 4, 3, 2)
