"""Temporal list join: which dated list entries hold for a capture at its fetch time.

In DataFrame functions only. The list is a log of dated events (add or remove of
an entry); events become validity intervals, and an as-of join gives every
capture the entries that were active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user, port or trailing dot; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit("."))


def url_path(url: Column) -> Column:
    """Path of a URL without query and fragment; empty if there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*(/[^?#]*)", 1)


def url_keys(url: Column) -> Column:
    """Every list key a URL can match: its host and all parent domains (``com`` too), and host plus each path prefix.

    Prefixes end at path segments: ``a.b/x/y`` has the keys a.b, b, a.b/x and a.b/x/y.
    """
    labels = F.split(url_host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(url_path(url), "/"), lambda p: p != "")
    paths = F.transform(
        F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(url_host(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
    )
    return F.when(url_host(url) != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def validity_intervals(events: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) from a log (key, day, action), action one of block, allow, remove.

    Per key and day the strictest event of the day counts (block before allow
    before remove); an entry holds from its day until the key's next event day,
    the last one for ever (null ``valid_to``). Events with a null key, day or action,
    or an unknown action, are no events. A key's window holds at most one row a day.
    """
    rank = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).when(F.col("action") == "remove", 1)
    daily = (
        events.select("key", F.col("day").cast("date").alias("day"), rank.alias("rank"))
        .where("key IS NOT NULL AND day IS NOT NULL AND rank IS NOT NULL")
        .groupBy("key", "day")
        .agg(F.max("rank").alias("rank"))
    )
    spans = daily.withColumn("valid_to", F.lead("day").over(Window.partitionBy("key").orderBy("day")))
    return spans.where("rank > 1").select(
        "key", F.when(F.col("rank") == 3, "block").otherwise("allow").alias("action"), F.col("day").alias("valid_from"), "valid_to"
    )


def filter_captures(captures: DataFrame, events: DataFrame) -> DataFrame:
    """Evaluate every capture (id, url, fetched date) against the entries active on its day.

    Returns (id, n_active, rule, rule_action, rule_from, blocked): the number
    of active entries that match, the most specific of them (a path before a
    host, a longer key before a shorter one, then by text) and its verdict. Without a match,
    without a host or with a null date: 0, nulls, false. One row per input row;
    rows that repeat an id are told apart, so each keeps its own row.

    Intervals are dealt to the months they touch, so the equi-join on (key,
    month) meets at most 31 intervals of a key for one capture, however long the
    key's history; a popular host is a skewed join key that adaptive execution splits.
    """
    month = lambda d: F.year(d) * 12 + F.month(d)
    c = captures.select("id", "url", F.col("fetched").cast("date").alias("fetched"), F.monotonically_increasing_id().alias("row"))
    keyed = c.select("row", "id", "fetched", month("fetched").alias("month"), F.explode_outer(url_keys(F.col("url"))).alias("key"))
    spans = validity_intervals(events)
    # an open interval reaches the last capture's month
    last = captures.agg(F.max(month(F.col("fetched").cast("date"))).alias("last_month"))
    spans = spans.withColumn("last_month", last.scalar())
    end = F.coalesce(month(F.date_sub("valid_to", 1)), F.col("last_month"))
    spans = spans.where(F.col("last_month").isNotNull()).withColumn("end_month", F.least(end, F.col("last_month")))
    spans = spans.where(F.col("end_month") >= month("valid_from")).select(
        F.col("key"), "action", "valid_from", "valid_to", F.explode(F.sequence(month("valid_from"), F.col("end_month"))).alias("month")
    )
    on = (
        (keyed.key == spans.key)
        & (keyed.month == spans.month)
        & (spans.valid_from <= keyed.fetched)
        & (spans.valid_to.isNull() | (keyed.fetched < spans.valid_to))
    )
    hit = keyed.join(spans, on, "left").select(
        "row", "id", F.when(spans.action.isNotNull(), F.struct(F.instr(keyed.key, "/") > 0, F.length(keyed.key), keyed.key.alias("rule"), "action", "valid_from")).alias("hit")
    )
    best = hit.groupBy("row", "id").agg(F.count("hit").alias("n_active"), F.max("hit").alias("hit"))
    return best.select(
        "id",
        "n_active",
        F.col("hit.rule").alias("rule"),
        F.col("hit.action").alias("rule_action"),
        F.col("hit.valid_from").alias("rule_from"),
        F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
    )
