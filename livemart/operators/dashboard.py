"""Dashboard read queries: hour maps (A16), today vs yesterday (J5 + J6), cards (Q1).

Everything here runs on already-aggregated rows (at most 24 per day), so the
shuffles are tiny whatever the size of the underlying tables.
"""

from __future__ import annotations

from datetime import date as _date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.functions.shape import CARD_DAU, CARD_NEW_MID, CARD_ORDER_AMOUNT


def hour_map(values: DataFrame, date_col: str, hour_col: str, value_col: str) -> DataFrame:
    """Per day, a ``map<hour, value>`` (at most 24 entries): (date, m)."""
    return values.groupBy(date_col).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(hour_col), F.col(value_col)))).alias("m"))


def hour_compare(values: DataFrame, date_col: str, hour_col: str, value_col: str,
                 date: str | None = None, zero=0) -> DataFrame:
    """J5 + J6: for each day (or one ``date``), 24 rows hour ``00``..``23`` with
    today's and yesterday's value, 0 where an hour has none.

    Each (day, hour, value) row counts as "today" for its day and as
    "yesterday" for the next day; one aggregation per day folds both into
    hour maps (A16, at most 24 entries each), so there is no self join and
    the input is computed once.  Days come from the data (a day that only
    appears as someone's yesterday is not reported); a requested ``date``
    is always reported.  Output: (date, hour, today, yesterday).
    """
    if date is not None:
        values = values.where(F.col(date_col).isin(date, previous_date(date)))
    entry = F.struct(F.col(hour_col).alias("h"), F.col(value_col).alias("v"))
    next_day = F.date_format(F.date_add(F.to_date(F.col(date_col)), 1), "yyyy-MM-dd")
    both = values.select(F.explode(F.array(
        F.struct(F.col(date_col).alias("d"), F.lit(True).alias("today"), entry.alias("e")),
        F.struct(next_day.alias("d"), F.lit(False).alias("today"), entry.alias("e")))).alias("x")
    ).select("x.*")
    if date is not None:
        # the requested day always gets its 24 rows, even with no data at all
        marker = values.sparkSession.range(1).select(
            F.lit(date).alias("d"), F.lit(True).alias("today"),
            F.lit(None).cast(both.schema["e"].dataType).alias("e"))
        both = both.unionByName(marker).where(F.col("d") == date)
    maps = both.groupBy("d").agg(
        F.max(F.col("today").cast("int")).alias("has_today"),
        F.map_from_entries(F.collect_list(F.when(F.col("today"), F.col("e")))).alias("m"),
        F.map_from_entries(F.collect_list(F.when(~F.col("today"), F.col("e")))).alias("ym"))
    hour = F.lpad(F.col("_h").cast("string"), 2, "0")
    vtype = values.schema[value_col].dataType
    z = F.lit(zero).cast(vtype)
    return (maps.where(F.col("has_today") == 1)
                .select("d", "m", "ym", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
                .select(F.col("d").alias(date_col), hour.alias("hour"),
                        F.coalesce(F.col("m")[hour], z).alias("today"),
                        F.coalesce(F.col("ym")[hour], z).alias("yesterday")))


def previous_date(date: str) -> str:
    """P15 for a literal parameter: the day before ``yyyy-MM-dd``."""
    return (_date.fromisoformat(date) - timedelta(days=1)).isoformat()


def metric_cards(dau_per_day: DataFrame, new_per_day: DataFrame, amount_per_day: DataFrame,
                 date: str | None = None) -> DataFrame:
    """Q1: three cards per day: (date, id, name, value double).

    ``dau`` and ``newMid`` are 0 on a day without devices; ``order_amount`` is
    null on a day without orders (a sum of nothing).
    Inputs: (logdate, ct), (logdate, ct), (create_date, sum_amount).
    """
    cards = (CARD_DAU, CARD_NEW_MID, CARD_ORDER_AMOUNT)

    def spread(df, date_col, own, value):
        # every source row fills its own card and opens the day's other two
        slots = [F.struct(F.lit(c[0]).alias("id"),
                          (value if c[0] == own else F.lit(None)).cast("double").alias("value"))
                 for c in cards]
        return df.select(F.col(date_col).alias("date"), F.explode(F.array(*slots)).alias("x")) \
                 .select("date", "x.id", "x.value")

    rows = (spread(dau_per_day, "logdate", CARD_DAU[0], F.col("ct"))
            .unionByName(spread(new_per_day, "logdate", CARD_NEW_MID[0], F.col("ct")))
            .unionByName(spread(amount_per_day, "create_date", CARD_ORDER_AMOUNT[0], F.col("sum_amount"))))
    if date is not None:
        # the requested day always gets its three cards
        day = dau_per_day.sparkSession.range(1).select(F.lit(date).alias("d"))
        rows = rows.where(F.col("date") == date).unionByName(spread(day, "d", None, F.lit(None)))
    names = F.create_map(*[x for c in cards for x in (F.lit(c[0]), F.lit(c[1]))])
    summed = rows.groupBy("date", "id").agg(F.sum("value").alias("value"))
    value = F.when(F.col("id") == CARD_ORDER_AMOUNT[0], F.col("value")) \
             .otherwise(F.coalesce(F.col("value"), F.lit(0.0).cast("double")))
    return summed.select("date", "id", names[F.col("id")].alias("name"), value.alias("value"))
