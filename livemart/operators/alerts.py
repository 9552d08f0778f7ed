"""Coupon-abuse alerts over sliding windows (A2-A6, F5, ST2, ST6, P8).

Rule, per device and window: at least ``min_users`` distinct users claimed a
coupon and nobody clicked an item.  The alert carries the distinct coupon
users and items and every event id of the window in arrival order.

Batch form is pane based: ``window(ts, 30s, 5s)`` would copy every event into
window/slide windows *before* the shuffle.  Here each event is reduced
once to marks of its pane (gcd of window and slide): who claimed a coupon,
and whether anyone clicked.  Windows are decided by counting distinct marks,
and sets and the ordered event list are assembled only for the windows that
raise an alert.

Streaming form (``alerting_windows``): two chained aggregations.  The first
keeps one small row per device and pane: whether anyone clicked, and a
sketch of the distinct coupon users that is exact up to ``sketch_size``
users and never larger.  The second unites the panes of each window.  Neither
holds an event; the events of the few windows that alert are fetched from the
stored events (``assemble``), the step that ends the batch form too.
"""

from __future__ import annotations

from math import ceil, gcd, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.functions.timefmt import epoch_millis, millis_to_text
from livemart.operators.keyed import latest_per_key

COUPON = "coupon"
CLICK = "clickItem"
NULL_UID = "<null>"


def _uid(count_null_uid: bool):
    # A Java hash set counts a null user as one member; collect_set drops nulls.
    return F.coalesce(F.col("uid"), F.lit(NULL_UID)) if count_null_uid else F.col("uid")


def _ordered_evids(order_cols=("ts_ms", "event_id")):
    """Event ids sorted by (time, event id) -- arrival order made deterministic."""
    packed = F.collect_list(F.struct(*[F.col(c) for c in order_cols], F.col("evid")))
    return F.transform(F.array_sort(packed), lambda x: x["evid"])


def alert_row(mid, wstart_ms, wend_ms, uids, items, events) -> list:
    """P8 + output shape: id = device + '_' + minute of the window end."""
    return [
        F.concat_ws("_", mid, F.floor(wend_ms / F.lit(60000)).cast("string")).alias("id"),
        mid.alias("mid"),
        F.array_sort(uids).alias("uids"),
        F.array_sort(items).alias("itemIds"),
        events.alias("events"),
        wend_ms.cast("bigint").alias("ts"),
        millis_to_text(wstart_ms).alias("window_start"),
        millis_to_text(wend_ms).alias("window_end"),
    ]


def coupon_alerts(events: DataFrame, window_ms: int, slide_ms: int, min_users: int = 3,
                  count_null_uid: bool = False) -> DataFrame:
    """Alerts of every (device, window) that passes the rule (batch, pane based).

    ``events``: event logs with mid, uid, evid, itemid, ts_ms, event_id.
    Windows start at multiples of ``slide_ms`` from the epoch and hold
    [start, start + window_ms), as Spark's ``window()`` does.
    """
    if not 0 < slide_ms <= window_ms:
        raise ValueError("need 0 < slide <= window (as Spark's window() does)")
    pane_ms = gcd(window_ms, slide_ms)
    ev = _paned(events, pane_ms, count_null_uid)
    return assemble(ev, _alerting(ev, window_ms, slide_ms, pane_ms, min_users), window_ms, pane_ms)


def _paned(events: DataFrame, pane_ms: int, count_null_uid: bool) -> DataFrame:
    return events.select("mid", _uid(count_null_uid).alias("uid"), "evid", "itemid", "ts_ms", "event_id",
                         (F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(pane_ms))).alias("pane"))


def _starts(pane_ms: int, window_ms: int, slide_ms: int):
    """The aligned starts s of the windows that hold pane p: p + pane - window <= s <= p."""
    lo = F.col("pane") + F.lit(pane_ms - window_ms)
    s_lo = lo - F.pmod(lo, F.lit(slide_ms)) + F.when(F.pmod(lo, F.lit(slide_ms)) == 0, 0).otherwise(slide_ms)
    s_hi = F.col("pane") - F.pmod(F.col("pane"), F.lit(slide_ms))
    return F.explode(F.sequence(s_lo, s_hi, F.lit(slide_ms).cast("bigint"))).alias("wstart")


def _alerting(ev: DataFrame, window_ms: int, slide_ms: int, pane_ms: int, min_users: int) -> DataFrame:
    """(mid, wstart) of the windows that pass the rule."""
    # the decision needs only who claimed a coupon and whether anyone clicked:
    # one row per (device, pane, user or click), copied into the windows that
    # hold its pane and counted; no set of users or items is gathered
    is_coupon, is_click = F.col("evid") == COUPON, F.col("evid") == CLICK
    marks = (ev.where(is_coupon | is_click)
               .select("mid", "pane", is_click.alias("click"), F.when(is_coupon, F.col("uid")).alias("buyer"))
               .distinct())
    windows = (marks.select("mid", _starts(pane_ms, window_ms, slide_ms), "click", "buyer").distinct()
                    .groupBy("mid", "wstart").agg(F.count("buyer").alias("buyers"),
                                                  F.bool_or("click").alias("clicked")))
    return windows.where((F.col("buyers") >= min_users) & ~F.col("clicked")).select("mid", "wstart")


def _panes_of(windows: DataFrame, window_ms: int, pane_ms: int) -> DataFrame:
    """(alert_mid, wstart, alert_pane): the panes of each (mid, wstart)."""
    span = F.sequence(F.col("wstart"), F.col("wstart") + F.lit(window_ms - pane_ms), F.lit(pane_ms).cast("bigint"))
    return windows.select(F.col("mid").alias("alert_mid"), "wstart", F.explode(span).alias("alert_pane"))


def _inside(ev: DataFrame, panes: DataFrame) -> DataFrame:
    same = ev["mid"].eqNullSafe(panes["alert_mid"]) & (ev["pane"] == panes["alert_pane"])  # null devices too
    return ev.join(panes, same, "inner")


def assemble(ev: DataFrame, alerting: DataFrame, window_ms: int, pane_ms: int) -> DataFrame:
    """The alert rows of the ``alerting`` windows (mid, wstart), from the events ``ev`` (``_paned``).

    Raw events are joined to those windows' panes (map-side when that side is
    small), so events outside any alert never reach the final collect.  A
    window's events are collected and sorted per pane first (a hot device's
    window is split into window/pane groups across tasks); the final step
    only concatenates the pane lists in time order.
    """
    is_coupon = F.col("evid") == COUPON
    per_pane = (_inside(ev, _panes_of(alerting, window_ms, pane_ms))
                  .groupBy("mid", "wstart", "pane").agg(
                      F.collect_set(F.when(is_coupon, F.col("uid"))).alias("uids"),
                      F.collect_set(F.when(is_coupon, F.col("itemid"))).alias("items"),
                      _ordered_evids().alias("evs")))
    out = per_pane.groupBy("mid", "wstart").agg(
        F.array_distinct(F.flatten(F.collect_list("uids"))).alias("uids"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pane", "evs"))),
                              lambda x: x["evs"])).alias("events"))
    wend = F.col("wstart") + F.lit(window_ms)
    return out.select(*alert_row(F.col("mid"), F.col("wstart"), wend, F.col("uids"),
                                 F.col("items"), F.col("events")))


def sketch_size(min_users: int) -> int:
    """Log2 of the entries up to which a user sketch counts exactly: more than ``min_users``."""
    return max(4, ceil(log2(min_users + 1)))


def alerting_windows(events: DataFrame, window_ms: int, slide_ms: int, min_users: int = 3,
                     count_null_uid: bool = False, time_col: str = "event_time") -> DataFrame:
    """Streaming rule: (mid, wstart) of every window that passes it, once, when the watermark has closed it.

    Only claims and clicks enter the state: a row per device and open pane,
    then one per device and open window.  A sketch keeps at most the users
    it counts exactly (``sketch_size``); beyond that there are more than
    ``min_users`` anyhow, so the decision is exact.  Each window is decided once
    all its events are in, so an alert never has to be withdrawn.
    """
    pane_ms = gcd(window_ms, slide_ms)
    size = sketch_size(min_users)
    is_coupon, is_click = F.col("evid") == COUPON, F.col("evid") == CLICK
    # sketches leave out empty texts, which are users like others: hence the prefix
    buyer = F.when(is_coupon, F.concat(F.lit("u"), _uid(count_null_uid)))
    # naming the time keeps this filter above the watermark: every event moves the clock
    panes = (events.where(is_coupon | is_click | F.col(time_col).isNull())
                   .groupBy("mid", F.window(time_col, f"{pane_ms} milliseconds").alias("p"))
                   .agg(F.theta_sketch_agg(buyer, size).alias("buyers"), F.bool_or(is_click).alias("clicked")))
    span = F.window(F.window_time("p"), f"{window_ms} milliseconds", f"{slide_ms} milliseconds")
    windows = panes.groupBy("mid", span.alias("w")).agg(F.theta_union_agg("buyers", size).alias("buyers"),
                                                        F.bool_or("clicked").alias("clicked"))
    passes = (F.theta_sketch_estimate("buyers") >= min_users) & ~F.col("clicked")
    return windows.where(passes).select("mid", epoch_millis(F.col("w.start")).alias("wstart"))


def alerts_of(events: DataFrame, windows: DataFrame, window_ms: int, slide_ms: int,
              count_null_uid: bool = False) -> DataFrame:
    """The alert rows of given windows (mid, wstart), their events taken from ``events`` (batch)."""
    pane_ms = gcd(window_ms, slide_ms)
    return assemble(_paned(events, pane_ms, count_null_uid), windows, window_ms, pane_ms)


def touched_windows(events: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """(mid, wstart) of every window that holds one of ``events``."""
    pane_ms = gcd(window_ms, slide_ms)
    panes = _paned(events, pane_ms, False).select("mid", "pane").distinct()
    return panes.select("mid", _starts(pane_ms, window_ms, slide_ms)).distinct()


def decided_again(events: DataFrame, windows: DataFrame, window_ms: int, slide_ms: int, min_users: int = 3,
                  count_null_uid: bool = False) -> DataFrame:
    """The alert rows of those ``windows`` (mid, wstart) that pass the rule over ``events``.

    Only the events of the windows' panes are read beyond the join.
    """
    pane_ms = gcd(window_ms, slide_ms)
    ev = _paned(events, pane_ms, count_null_uid)
    panes = _panes_of(windows, window_ms, pane_ms).select("alert_mid", "alert_pane").distinct()
    near = _inside(ev, panes).drop("alert_mid", "alert_pane")
    passing = _alerting(near, window_ms, slide_ms, pane_ms, min_users)
    # a neighbouring window shares panes but was not asked for, and may lack events here
    asked = windows.select(F.col("mid").alias("asked_mid"), F.col("wstart").alias("asked"))
    same = passing["mid"].eqNullSafe(asked["asked_mid"]) & (passing["wstart"] == asked["asked"])
    return assemble(ev, passing.join(asked, same, "left_semi"), window_ms, pane_ms)


def windowed_alerts(events: DataFrame, window: str, slide: str, min_users: int = 3,
                    count_null_uid: bool = False, time_col: str = "event_time") -> DataFrame:
    """Early streaming form: Spark's sliding ``window()`` over a watermarked timestamp.

    Shows a window as soon as it alerts, at the price of every event of
    every open window in the state; ``alerting_windows`` is the bounded form.

    Emits every (device, window) with an ``ok`` flag; the rule is not
    monotone (a late click cancels an alert), so the sink's view filters on
    ``ok`` rather than dropping windows before the sink.
    """
    is_coupon = F.col("evid") == COUPON
    g = events.groupBy("mid", F.window(time_col, window, slide).alias("w")).agg(
        F.collect_set(F.when(is_coupon, _uid(count_null_uid))).alias("uids"),
        F.collect_set(F.when(is_coupon, F.col("itemid"))).alias("items"),
        F.coalesce(F.bool_or(F.col("evid") == CLICK), F.lit(False)).alias("clicked"),
        _ordered_evids().alias("events"))
    wstart = epoch_millis(F.col("w.start"))
    wend = epoch_millis(F.col("w.end"))
    ok = (F.size("uids") >= min_users) & ~F.col("clicked")
    return g.select(*alert_row(F.col("mid"), wstart, wend, F.col("uids"), F.col("items"),
                               F.col("events")), ok.alias("ok"))


def per_minute(alerts: DataFrame) -> DataFrame:
    """ST6: at most one alert per device and minute; the latest window wins."""
    return latest_per_key(alerts, ["id"], ["ts", "window_start"], alerts.columns)


def for_day(alerts: DataFrame, date: str) -> DataFrame:
    """Q7: the alerts of one day (by window end), as the alert index would list them."""
    return alerts.where(F.substring(F.col("window_end"), 1, 10) == date)
