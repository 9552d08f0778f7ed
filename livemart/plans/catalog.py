"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the whole input tables through the adapters and runs the
library operators; results are shaped for comparison with the SQL oracle
(arrays joined to strings, times as text, money as exact sums in double).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livemart.functions.json import parse
from livemart.functions.timefmt import date_or_today
from livemart.operators import alerts, dashboard, dau, ingest, orders, sales, search
from livemart.plans import params as P
from livemart.schemas import RAW_LOG, SALE_DETAIL_COLUMNS
from livemart.sources import adapters as A
from livemart.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


# ---- intake -----------------------------------------------------------------

def _stamped_logs(spark, sf_dir):
    # the intake is replayed with each log's recorded time as the server stamp
    raw = A.raw_log_json(spark, sf_dir)
    return ingest.route_logs(ingest.stamp_logs(raw, stamp=F.col("ts_ms")))


def log_route(spark, sf_dir):
    """F3, P21, P7, SNK8: every raw log stamped and routed: (event_id, topic, value)."""
    return _stamped_logs(spark, sf_dir).select("event_id", "topic", "value")


def log_date_hour(spark, sf_dir):
    """Log day and hour from the stamped epoch-ms time."""
    st = _stamped_logs(spark, sf_dir).select("event_id", F.col("log.ts").alias("ts"))
    return ingest.log_day_hour(st, "ts").select("event_id", "logdate", "loghour")


def log_json_roundtrip(spark, sf_dir):
    """P1 + P2: stamped text parsed back into the typed log record."""
    st = _stamped_logs(spark, sf_dir)
    return st.select("event_id", parse("value", RAW_LOG).alias("r")).select("event_id", "r.*")


def log_type_route(spark, sf_dir):
    """P21 + F3: raw text routed by its extracted type, without parsing the record."""
    return ingest.route_logs(A.raw_log_json(spark, sf_dir)).select("event_id", "topic")


def cdc_route(spark, sf_dir):
    """SRC3, F1, F2, P3, SNK9: change entries routed to topics as JSON rows."""
    routed = ingest.route_changes(A.change_envelope(spark, sf_dir), table_pattern=P.CDC_TABLES)
    return routed.select("topic", "value")


# ---- daily active devices -------------------------------------------------------

def _dau(spark, sf_dir):
    return dau.daily_active(A.startup_logs(spark, sf_dir))


def dau_first(spark, sf_dir):
    """A1 / ST3 batch form: the first start-up per device per day."""
    return _dau(spark, sf_dir)


def dau_new_vs_seen(spark, sf_dir):
    """Afternoon start-ups of devices not seen that morning, first per device/day.

    First-per-key and the anti join share the key, so they commute; reducing
    the batch first (map-side combined) means a hot device reaches the join
    as one row per map task instead of all of its rows.
    """
    st = A.startup_logs(spark, sf_dir)
    seen = st.where(F.col("loghour") < P.SEEN_BEFORE_HOUR)
    batch = st.where(F.col("loghour") >= P.SEEN_BEFORE_HOUR)
    return dau.unseen(dau.daily_active(batch), seen)


def dau_total(spark, sf_dir):
    """A7 per day."""
    return dau.dau_total(_dau(spark, sf_dir))


def dau_hour(spark, sf_dir):
    """A8 per day and hour (from the first start-up time of each device and day)."""
    return dau.dau_hour_of_logs(A.startup_logs(spark, sf_dir))


def dau_hour_compare(spark, sf_dir):
    """Q2: J5 + J6 over every day."""
    return dashboard.hour_compare(dau.dau_hour_of_logs(A.startup_logs(spark, sf_dir)),
                                  "logdate", "loghour", "ct")


def dau_hour_map(spark, sf_dir):
    """The hour map of each day, as text ``hour:count`` in hour order."""
    m = dashboard.hour_map(dau.dau_hour_of_logs(A.startup_logs(spark, sf_dir)), "logdate", "loghour", "ct")
    pairs = F.transform(F.array_sort(F.map_entries("m")),
                        lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return m.select("logdate", F.array_join(pairs, ",").alias("hours"))


def dau_hour_day(spark, sf_dir):
    """Q2 for one day (F6, P15): that day's 24 hours next to the day before."""
    start = dau.dau_hour_of_logs(A.startup_logs(spark, sf_dir))
    return dashboard.hour_compare(start, "logdate", "loghour", "ct", date=P.DASH_DATE)


def dau_hour_today(spark, sf_dir):
    """Q2 + P16: without a date the dashboard asks for today's hours (zeros where the tables end earlier)."""
    start = dau.dau_hour_of_logs(A.startup_logs(spark, sf_dir))
    today = spark.range(1).select(date_or_today(None).alias("d")).first()["d"]
    return dashboard.hour_compare(start, "logdate", "loghour", "ct", date=today)


def new_devices(spark, sf_dir):
    """Q1 newMid: devices by the day of their first start-up ever."""
    return dau.new_devices(A.startup_logs(spark, sf_dir))


# ---- orders ----------------------------------------------------------------------

def _orders(spark, sf_dir, with_customer=False, day=None):
    return orders.order_info(A.order_rows(spark, sf_dir, with_customer=with_customer, day=day))


def order_masked(spark, sf_dir):
    """P5 + P6: the 20 order columns, masked phone, derived date and hour."""
    return _orders(spark, sf_dir, with_customer=True)


def order_amount_total(spark, sf_dir):
    """A9 per day."""
    return orders.amount_total(_orders(spark, sf_dir))


def order_amount_hour(spark, sf_dir):
    """A10 per day and hour."""
    return orders.amount_hour(_orders(spark, sf_dir))


def order_amount_hour_compare(spark, sf_dir):
    """Q3: J5 + J6 over every day."""
    return dashboard.hour_compare(orders.amount_hour(_orders(spark, sf_dir)),
                                  "create_date", "create_hour", "sum_amount", zero=0.0)


def metric_cards(spark, sf_dir):
    """Q1: dau, newMid and order_amount cards for every day."""
    # both device cards come from the distinct (day, device) set: one shuffle, reused
    keys = dau.device_days(A.startup_logs(spark, sf_dir))
    return dashboard.metric_cards(dau.dau_total(keys), dau.new_devices(keys),
                                  orders.amount_total(_orders(spark, sf_dir)))


def metric_cards_day(spark, sf_dir):
    """Q1 for one day (F6): the three cards of ``DASH_DATE``."""
    keys = dau.device_days(A.startup_logs(spark, sf_dir))
    return dashboard.metric_cards(dau.dau_total(keys, P.DASH_DATE), dau.new_devices(keys),
                                  orders.amount_total(_orders(spark, sf_dir)), date=P.DASH_DATE)


def province_sales(spark, sf_dir):
    """Q8: orders per province with the legend band (nation names joined).

    Orders are counted per customer first (map-side combined), so the
    customer join sees one row per ordering customer, not one per order.
    """
    from livemart.functions.shape import value_band
    per_user = _orders(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"]).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_nationkey").cast("string").alias("province_id"))
    counts = (per_user.join(cust, "user_id", "left")
                      .groupBy("province_id").agg(F.sum("n").alias("cnt")))
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).select(
        F.col("n_nationkey").cast("string").alias("province_id"), F.col("n_name").alias("province"))
    return (counts.join(nation, "province_id", "left")
                  .select("province_id", "province", "cnt", value_band("cnt").alias("band")))


# ---- sale detail -------------------------------------------------------------------

def _sale_detail(spark, sf_dir, day=None):
    o = _orders(spark, sf_dir, with_customer=False, day=day)
    return sales.sale_detail(o, A.order_detail(spark, sf_dir), A.user_info(spark, sf_dir), P.AS_OF)


def sale_detail(spark, sf_dir):
    """(order ⋈ line) ⟕ user."""
    return _sale_detail(spark, sf_dir)


def sale_unmatched(spark, sf_dir):
    """J2 outer sides: orders without lines, lines without orders."""
    return sales.unmatched(_orders(spark, sf_dir), A.order_detail_keys(spark, sf_dir))


def user_latest(spark, sf_dir):
    """A18 / ST12: latest version of each user from the change log."""
    return sales.latest_users(A.user_changes(spark, sf_dir))


def _matched(spark, sf_dir, level=None):
    return search.search(_sale_detail(spark, sf_dir, day=P.SEARCH_DATE), P.SEARCH_DATE,
                         P.SEARCH_KEYWORD, level)


def sale_search_page(spark, sf_dir):
    """Q4: F7 + F8 + L1 + L2: one page of hits, relevance then id."""
    return search.page(_matched(spark, sf_dir), P.PAGE_NO, P.PAGE_SIZE).select(
        *SALE_DETAIL_COLUMNS, "score")


def sale_search_page2(spark, sf_dir):
    """L1 + L5: the page of a row offset (the second one)."""
    page_no = search.page_from_offset(P.PAGE2_OFFSET, P.PAGE_SIZE)
    return search.page(_matched(spark, sf_dir), page_no, P.PAGE_SIZE).select(
        *SALE_DETAIL_COLUMNS, "score")


def sale_search_level(spark, sf_dir):
    """the hits of one user level."""
    return _matched(spark, sf_dir, P.SEARCH_LEVEL).select(*SALE_DETAIL_COLUMNS, "score")


def sale_total(spark, sf_dir):
    """A13."""
    return search.total(_matched(spark, sf_dir))


def sale_gender_topk(spark, sf_dir):
    """Top-2 genders by hits."""
    return search.terms_facet(_matched(spark, sf_dir), "user_gender", search.GENDER_TOP)


def sale_age_topk(spark, sf_dir):
    """Top-100 ages by hits."""
    return search.terms_facet(_matched(spark, sf_dir), "user_age", search.AGE_TOP)


def sale_gender_share(spark, sf_dir):
    """Q5."""
    return search.gender_share(_matched(spark, sf_dir))


def sale_age_share(spark, sf_dir):
    """Q6."""
    return search.age_share(_matched(spark, sf_dir))


def sale_search_result(spark, sf_dir):
    """Q4-Q6 as the API returns them: total, option groups and the page, rendered as JSON."""
    return _result_json(_matched(spark, sf_dir))


def _result_json(matched):
    return _rendered(search.result(matched, P.PAGE_NO, P.PAGE_SIZE))


def _rendered(r):
    keep_nulls = {"ignoreNullFields": "false"}
    return r.select("total", F.to_json("stat", keep_nulls).alias("stat_json"),
                    F.to_json("detail", keep_nulls).alias("detail_json"))


def sale_facets(spark, sf_dir):
    """Gender, age band and total in one grouping-sets pass."""
    return search.facets(_matched(spark, sf_dir))


# ---- alerts ---------------------------------------------------------------------------

def _alerts(spark, sf_dir):
    return alerts.coupon_alerts(A.event_logs(spark, sf_dir), P.ALERT_WINDOW_MS, P.ALERT_SLIDE_MS,
                                P.ALERT_MIN_USERS)


def _flat_alerts(df):
    return df.select("id", "mid", F.array_join("uids", ",").alias("uids"),
                     F.array_join("itemIds", ",").alias("itemIds"),
                     F.array_join("events", ",").alias("events"), "ts", "window_start", "window_end")


def coupon_alert_windows(spark, sf_dir):
    """A2-A6, F5, ST2: every alerting (device, window), arrays as text."""
    return _flat_alerts(_alerts(spark, sf_dir))


def coupon_alert_minute(spark, sf_dir):
    """ST6 + P8: one alert per device and minute, latest window wins."""
    return _flat_alerts(alerts.per_minute(_alerts(spark, sf_dir)))


def coupon_alert_day(spark, sf_dir):
    """Q7: the alerts of one day, one per device and minute."""
    return alerts.for_day(coupon_alert_minute(spark, sf_dir), P.DASH_DATE)


def dense_events(spark, sf_dir):
    """Event logs on the time scale of live traffic (epoch ms divided by ``LIVE_DIVISOR``)."""
    return A.event_logs(spark, sf_dir).withColumn(
        "ts_ms", F.floor(F.col("ts_ms") / F.lit(P.LIVE_DIVISOR)).cast("bigint"))


def coupon_alert_30s(spark, sf_dir):
    """A2-A6, F5, ST2 at 30 s / 5 s: every alerting (device, window)."""
    return _flat_alerts(alerts.coupon_alerts(dense_events(spark, sf_dir), P.LIVE_WINDOW_MS,
                                             P.LIVE_SLIDE_MS, P.ALERT_MIN_USERS))


def coupon_alert_30s_minute(spark, sf_dir):
    """ST6 at 30 s / 5 s: several windows share a minute, the latest one stays."""
    return alerts.per_minute(coupon_alert_30s(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "log_route": log_route,
    "log_date_hour": log_date_hour,
    "log_json_roundtrip": log_json_roundtrip,
    "log_type_route": log_type_route,
    "cdc_route": cdc_route,
    "dau_first": dau_first,
    "dau_new_vs_seen": dau_new_vs_seen,
    "dau_total": dau_total,
    "dau_hour": dau_hour,
    "dau_hour_compare": dau_hour_compare,
    "dau_hour_map": dau_hour_map,
    "dau_hour_day": dau_hour_day,
    "dau_hour_today": dau_hour_today,
    "new_devices": new_devices,
    "order_masked": order_masked,
    "order_amount_total": order_amount_total,
    "order_amount_hour": order_amount_hour,
    "order_amount_hour_compare": order_amount_hour_compare,
    "metric_cards": metric_cards,
    "metric_cards_day": metric_cards_day,
    "province_sales": province_sales,
    "user_latest": user_latest,
    "sale_detail": sale_detail,
    "sale_unmatched": sale_unmatched,
    "sale_search_page": sale_search_page,
    "sale_search_page2": sale_search_page2,
    "sale_search_level": sale_search_level,
    "sale_total": sale_total,
    "sale_gender_topk": sale_gender_topk,
    "sale_age_topk": sale_age_topk,
    "sale_gender_share": sale_gender_share,
    "sale_age_share": sale_age_share,
    "sale_facets": sale_facets,
    "sale_search_result": sale_search_result,
    "coupon_alert_windows": coupon_alert_windows,
    "coupon_alert_minute": coupon_alert_minute,
    "coupon_alert_day": coupon_alert_day,
    "coupon_alert_30s": coupon_alert_30s,
    "coupon_alert_30s_minute": coupon_alert_30s_minute,
}
