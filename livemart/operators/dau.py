"""Daily active devices: first start-up per device per day and its counts.

A1 first-per-key, J1 anti-join with the already-seen set, A7/A8 counts and
the first-ever-day of a device (``newMid`` of the metric cards).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.functions.timefmt import millis_to_hour
from livemart.operators.keyed import first_per_key
from livemart.schemas import DAU_COLUMNS

# Earliest start-up wins; the event id breaks ties in time.
DAU_KEY = ("logdate", "mid")
DAU_ORDER = ("ts_ms", "event_id")


def daily_active(startups: DataFrame) -> DataFrame:
    """A1 + ST3 (batch form): the first start-up of each device on each log day.

    Keyed by the log's own day (not the processing day).  Output: the DAU row
    (mid, uid, appid, area, os, ch, type, vs, logdate, loghour, ts epoch ms).
    """
    cols = [c for c in DAU_COLUMNS if c != "ts"] + list(DAU_ORDER)
    first = first_per_key(startups, DAU_KEY, DAU_ORDER, cols)
    return first.select(*[c for c in DAU_COLUMNS if c != "ts"], F.col("ts_ms").alias("ts"))


def unseen(batch: DataFrame, seen: DataFrame, keys=DAU_KEY) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen`` (left anti join).

    ``seen`` is reduced to its distinct keys first (map-side combined), and
    the planner picks broadcast or shuffle from its measured size.
    """
    seen_keys = seen.select(*keys).distinct()
    return batch.join(seen_keys, list(keys), "left_anti")


def dau_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per day (or for one day): (logdate, ct)."""
    if date is not None:
        dau = dau.where(F.col("logdate") == date)
    return dau.groupBy("logdate").agg(F.count(F.lit(1)).alias("ct"))


def dau_hour(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per day and hour of first start-up: (logdate, loghour, ct)."""
    if date is not None:
        dau = dau.where(F.col("logdate") == date)
    return dau.groupBy("logdate", "loghour").agg(F.count(F.lit(1)).alias("ct"))


def device_days(startups: DataFrame) -> DataFrame:
    """Distinct (logdate, mid): the keys of the DAU table, without the payload."""
    return startups.select(*DAU_KEY).distinct()


def new_devices(startups: DataFrame) -> DataFrame:
    """Q1 ``newMid``: devices whose first start-up ever falls on the day: (logdate, ct).

    Works on raw start-ups or on ``device_days``.  The minimum is taken over a
    ``date`` (fixed width, so a hash aggregate) rather than over the text.
    """
    first_day = startups.groupBy("mid").agg(F.min(F.to_date("logdate")).alias("d"))
    return (first_day.groupBy(F.date_format("d", "yyyy-MM-dd").alias("logdate"))
                     .agg(F.count(F.lit(1)).alias("ct")))


def first_start(startups: DataFrame) -> DataFrame:
    """Earliest start-up time per device and log day: (logdate, mid, first_ms).

    A long minimum is a hash aggregate with a fixed-width buffer; use it
    where only the time of the first start-up matters, not its whole row.
    """
    return startups.groupBy(*DAU_KEY).agg(F.min("ts_ms").alias("first_ms"))


def dau_hour_of_logs(startups: DataFrame, date: str | None = None) -> DataFrame:
    """A8 straight from start-ups: devices per day and hour of their first start-up.

    Same answer as ``dau_hour(daily_active(startups))``: the first start-up's
    ``loghour`` is the hour of the minimum time (``loghour`` is derived from
    the log time), so the whole-row ``min_by`` is not needed.
    """
    if date is not None:
        startups = startups.where(F.col("logdate") == date)
    first = first_start(startups)
    return (first.groupBy("logdate", millis_to_hour("first_ms").alias("loghour"))
                 .agg(F.count(F.lit(1)).alias("ct")))
