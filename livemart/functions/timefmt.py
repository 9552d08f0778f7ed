"""Date and time scalar functions.

All return Columns built from built-in expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis_ntz(ts) -> Column:
    """Epoch milliseconds of a wall-clock (``timestamp_ntz``) value, read as UTC.

    Independent of the session time zone, unlike ``unix_millis`` which only
    takes zoned timestamps.
    """
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _col(ts))


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a zoned timestamp (``unix_millis``)."""
    return F.unix_millis(_col(ts))


def millis_to_wallclock(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> wall-clock ``timestamp_ntz`` in zone ``tz``.

    Independent of the session time zone, so results are the same on every
    cluster; pass the zone the reports are read in.
    """
    ntz = F.timestamp_add("MILLISECOND", _col(ms), F.expr(_EPOCH_NTZ))
    return ntz if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz)


def millis_to_date(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` in zone ``tz``."""
    return F.date_format(millis_to_wallclock(ms, tz), "yyyy-MM-dd")


def millis_to_hour(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> two-digit hour ``HH`` in zone ``tz``."""
    return F.date_format(millis_to_wallclock(ms, tz), "HH")


def millis_to_text(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> ``yyyy-MM-dd HH:mm:ss`` in zone ``tz``."""
    return F.date_format(millis_to_wallclock(ms, tz), "yyyy-MM-dd HH:mm:ss")


def datetime_date(create_time) -> Column:
    """P5: ``'yyyy-MM-dd HH:mm:ss'`` -> the date part (text before the space)."""
    return F.split_part(_col(create_time), F.lit(" "), F.lit(1))


def datetime_hour(create_time) -> Column:
    """P5: ``'yyyy-MM-dd HH:mm:ss'`` -> the hour part; ``''`` when there is no time."""
    time_part = F.split_part(_col(create_time), F.lit(" "), F.lit(2))
    return F.split_part(time_part, F.lit(":"), F.lit(1))


def server_stamp(stamp=None) -> Column:
    """The intake's server time stamp (epoch ms).

    ``stamp`` replaces the wall clock for replays and tests: an int (fixed
    time) or a Column (e.g. the recorded arrival time).
    """
    if stamp is None:
        return F.unix_millis(F.current_timestamp())
    if isinstance(stamp, int):
        return F.lit(stamp).cast("bigint")
    return _col(stamp).cast("bigint")


def previous_day(date_str) -> Column:
    """``yyyy-MM-dd`` of the day before."""
    return F.date_format(F.date_sub(F.to_date(_col(date_str)), 1), "yyyy-MM-dd")


def date_or_today(date: str | None) -> Column:
    """The given ``yyyy-MM-dd`` date, or today's date."""
    if date:
        return F.lit(date)
    return F.date_format(F.current_date(), "yyyy-MM-dd")
