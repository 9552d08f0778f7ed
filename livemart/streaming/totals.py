"""Live totals kept by the streams: signed deltas of an upsert, summed per day and hour.

An upsert replaces the stored version of a key.  Its effect on a total is the
new row's share less the old row's, so a batch needs the old versions of its
own keys only: a redelivered row cancels out, a changed one corrects its
day and hour, whatever they were.  The totals are a small keyed table
(metric, date, hour) that each batch upserts for the rows it touches, and the
dashboard reads it instead of recounting.

Reads before the own batch (``before_batch``) make a replayed batch write the
same numbers again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemart.operators import dau, orders
from livemart.operators.dashboard import metric_cards
from livemart.operators.keyed import latest_per_key
from livemart.streaming.jobs import _start
from livemart.streaming.upsert import KeyedTable

TOTAL_KEY = ("metric", "date", "hour")
AMOUNT = "decimal(28,2)"
DAU, NEW_MID, ORDER_AMOUNT = "dau", "new_mid", "order_amount"


def totals_table(path: str, compact_every: int | None = 100) -> KeyedTable:
    return KeyedTable(path, TOTAL_KEY, compact_every=compact_every,
                      schema=f"metric string, date string, hour string, rows long, amount {AMOUNT}")


def signed(old: DataFrame, new: DataFrame, metric: str, date: Column, hour: Column, amount: Column) -> DataFrame:
    """(metric, date, hour, rows, amount): what replacing rows ``old`` by ``new`` does to the totals."""
    def share(df: DataFrame, sign: int) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), date.alias("date"), hour.alias("hour"),
                         F.lit(sign).cast("long").alias("rows"), (amount * sign).cast(AMOUNT).alias("amount"))
    both = share(new, 1).unionByName(share(old, -1)).groupBy(*TOTAL_KEY).agg(
        F.sum("rows").alias("rows"), F.sum("amount").cast(AMOUNT).alias("amount"))
    return both.where("rows != 0 or amount != 0")


def add(totals: KeyedTable, deltas: DataFrame, batch_id: int) -> None:
    """Upsert the touched totals: those before this batch plus ``deltas``."""
    before = totals.view(deltas.sparkSession, keys=deltas.select(*TOTAL_KEY), before_batch=batch_id)
    before = before.select(*TOTAL_KEY, F.col("rows").alias("_rows"), F.col("amount").alias("_amount"))
    zero = F.lit(0).cast(AMOUNT)
    now = deltas.join(before, list(TOTAL_KEY), "left").select(
        *TOTAL_KEY, (F.col("rows") + F.coalesce("_rows", F.lit(0))).alias("rows"),
        (F.coalesce("amount", zero) + F.coalesce("_amount", zero)).cast(AMOUNT).alias("amount"))
    totals.write(now, batch_id)
    if totals.compact_every and batch_id and batch_id % totals.compact_every == 0:
        totals.compact(deltas.sparkSession, batch_id)


def dau_totals_query(startups: DataFrame, table: KeyedTable, devices: KeyedTable, totals: KeyedTable,
                     checkpoint: str, trigger: dict | None = None):
    """A7 + A8 + ``newMid`` live: start-ups upserted as first starts, first days and totals.

    ``table`` keeps the first start per day and device (laid out by day),
    ``devices`` the first day of each device (bucketed by device).  An earlier
    start or day replaces the stored one, and its total moves with it.
    """
    def _batch(df, bid):
        spark = df.sparkSession
        df.persist()
        try:
            first = dau.daily_active(df)
            old = table.view(spark, keys=first.select("logdate", "mid"), before_batch=bid)
            seen = old.select("logdate", "mid", F.col("ts").alias("_seen"))
            new = (first.join(seen, ["logdate", "mid"], "left")
                   .where(F.col("_seen").isNull() | (F.col("ts") < F.col("_seen"))).select(*first.columns).persist())
            days = new.groupBy("mid").agg(F.min("logdate").alias("first_day"))
            known = devices.view(spark, keys=days.select("mid"), before_batch=bid)
            earlier = (days.join(known.select("mid", F.col("first_day").alias("_day")), "mid", "left")
                       .where(F.col("_day").isNull() | (F.col("first_day") < F.col("_day"))).drop("_day").persist())
            try:
                none = F.lit(0).cast(AMOUNT)
                moved = signed(old.join(new.select("logdate", "mid"), ["logdate", "mid"], "left_semi"), new, DAU,
                               F.col("logdate"), F.col("loghour"), none)
                began = signed(known.join(earlier.select("mid"), "mid", "left_semi"), earlier, NEW_MID,
                               F.col("first_day"), F.lit(""), none)
                add(totals, moved.unionByName(began), bid)
                table.write(new, bid)
                devices.write(earlier, bid)
            finally:
                new.unpersist()
                earlier.unpersist()
        finally:
            df.unpersist()
    return _start(startups, checkpoint, trigger, "append", _batch, "dau_totals")


def order_totals_query(orders_rows: DataFrame, table: KeyedTable, totals: KeyedTable, checkpoint: str,
                       trigger: dict | None = None):
    """A9 + A10 live: orders upserted by id, their amounts moved between totals.

    ``table`` is keyed by id (bucketed), with the version order that its
    ``order`` columns give: of several versions in a batch the last counts, and a version
    older than the stored one changes nothing.
    """
    order = table.order

    def _batch(df, bid):
        spark = df.sparkSession
        df.persist()
        try:
            rows = orders.order_info(df, keep=tuple(order)).select(
                "id", "create_date", "create_hour", F.col("total_amount").cast(AMOUNT).alias("total_amount"), *order)
            rows = latest_per_key(rows, ["id"], [*order, "create_date", "total_amount"])
            old = table.view(spark, keys=rows.select("id"), before_batch=bid)
            if order:
                stored = old.select("id", F.struct(*order).alias("_version"))
                rows = (rows.join(stored, "id", "left")
                        .where(F.col("_version").isNull() | (F.struct(*order) >= F.col("_version"))).drop("_version"))
            rows = rows.persist()
            try:
                changed = old.join(rows.select("id"), "id", "left_semi")
                add(totals, signed(changed, rows, ORDER_AMOUNT, F.col("create_date"), F.col("create_hour"),
                                   F.coalesce("total_amount", F.lit(0).cast(AMOUNT))), bid)
                table.write(rows, bid)
            finally:
                rows.unpersist()
        finally:
            df.unpersist()
    return _start(orders_rows, checkpoint, trigger, "append", _batch, "order_totals")


def _per(totals: KeyedTable, spark, metric: str, names: dict[str, str], value: Column) -> DataFrame:
    live = totals.view(spark).where((F.col("metric") == metric) & (F.col("rows") > 0))
    return live.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(value)


def live_hours(spark, totals: KeyedTable, metric: str) -> DataFrame:
    """Q2/Q3 input: (date, hour, value) of a metric, from the totals."""
    value = F.sum("amount").cast("double") if metric == ORDER_AMOUNT else F.sum("rows")
    return _per(totals, spark, metric, {"date": "date", "hour": "hour"}, value.alias("value"))


def live_cards(spark, day_totals: KeyedTable, order_totals: KeyedTable, date: str | None = None) -> DataFrame:
    """Q1 from the totals: the three cards of every day, or of one."""
    count = F.sum("rows").alias("ct")
    return metric_cards(_per(day_totals, spark, DAU, {"date": "logdate"}, count),
                        _per(day_totals, spark, NEW_MID, {"date": "logdate"}, count),
                        _per(order_totals, spark, ORDER_AMOUNT, {"date": "create_date"},
                             F.sum("amount").cast("double").alias("sum_amount")), date)
