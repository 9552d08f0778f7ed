"""Literal rows for the traps of the upstream jobs (FIXTURES.md §4)."""

import json
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from livemart.functions.masking import mask_phone
from livemart.functions.numeric import age_years, percent_1dp
from livemart.functions.timefmt import datetime_date, datetime_hour, epoch_millis_ntz
from livemart.operators import alerts, dashboard, dau, ingest, orders, sales, search
from livemart.schemas import TOPIC_EVENT, TOPIC_ORDER, TOPIC_STARTUP, TOPIC_USER


def _ms(s):
    return int((datetime.fromisoformat(s) - datetime(1970, 1, 1)).total_seconds() * 1000)


def startup(spark, rows):
    recs = [Row(event_id=i, ts_ms=_ms(t), mid=m, uid="u", appid="a", area="x", os="ios", ch="c",
                type="startup", vs="1", logdate=t[:10], loghour=t[11:13]) for i, (m, t) in enumerate(rows)]
    return spark.createDataFrame(recs)


def events(spark, rows):
    recs = [Row(event_id=i, mid=m, uid=u, evid=e, itemid=str(i), ts_ms=_ms(t))
            for i, (m, u, e, t) in enumerate(rows)]
    return spark.createDataFrame(recs, "event_id long, mid string, uid string, evid string, itemid string, ts_ms long")


def test_dau_keys_by_log_day_and_keeps_earliest(spark):
    # m1 seen at 10:00 and again at 23:59:59 of the same log day; m2 arrives late-first
    df = startup(spark, [("m1", "2024-01-01 10:00:00"), ("m1", "2024-01-01 23:59:59"),
                         ("m2", "2024-01-01 10:00:05"), ("m2", "2024-01-01 10:00:01"),
                         ("m1", "2024-01-02 00:00:01")])
    got = {(r.logdate, r.mid): r.loghour + ":" + str(r.ts) for r in dau.daily_active(df).collect()}
    assert got == {("2024-01-01", "m1"): "10:" + str(_ms("2024-01-01 10:00:00")),
                   ("2024-01-01", "m2"): "10:" + str(_ms("2024-01-01 10:00:01")),
                   ("2024-01-02", "m1"): "00:" + str(_ms("2024-01-02 00:00:01"))}


def test_unseen_anti_join(spark):
    seen = startup(spark, [("m1", "2024-01-01 08:00:00")])
    batch = startup(spark, [("m1", "2024-01-01 13:00:00"), ("m2", "2024-01-01 13:00:00"),
                            ("m1", "2024-01-02 13:00:00")])
    got = sorted((r.logdate, r.mid) for r in dau.unseen(batch, seen).collect())
    assert got == [("2024-01-01", "m2"), ("2024-01-02", "m1")]


H6, H1 = 6 * 3600 * 1000, 3600 * 1000


def _alert_ids(spark, rows, **kw):
    return alerts.coupon_alerts(events(spark, rows), H6, H1, **kw).collect()


def test_alert_counts_users_not_claims(spark):
    rows = [("d", "u1", "coupon", "2024-01-01 00:10:00"), ("d", "u1", "coupon", "2024-01-01 00:20:00"),
            ("d", "u2", "coupon", "2024-01-01 00:30:00")]
    assert _alert_ids(spark, rows) == []


def test_alert_click_in_window_cancels(spark):
    rows = [("d", "u1", "coupon", "2024-01-01 00:10:00"), ("d", "u2", "coupon", "2024-01-01 00:20:00"),
            ("d", "u3", "coupon", "2024-01-01 00:30:00"), ("d", "u4", "clickItem", "2024-01-01 00:40:00")]
    assert _alert_ids(spark, rows) == []


def test_alert_fires_in_every_covering_window(spark):
    rows = [("d", "u1", "coupon", "2024-01-01 00:10:00"), ("d", "u2", "addCart", "2024-01-01 00:15:00"),
            ("d", "u2", "coupon", "2024-01-01 00:20:00"), ("d", "u3", "coupon", "2024-01-01 00:30:00")]
    got = _alert_ids(spark, rows)
    # windows [-5h,+1h) ... [0h,6h) hold all four events
    assert len(got) == 6
    r = sorted(got, key=lambda r: r.ts)[-1]
    assert r.uids == ["u1", "u2", "u3"]
    assert r.events == ["coupon", "addCart", "coupon", "coupon"]
    assert r.id == "d_" + str((_ms("2024-01-01 00:00:00") + H6) // 60000)


def test_alert_null_uid_counts_only_when_asked(spark):
    rows = [("d", "u1", "coupon", "2024-01-01 00:10:00"), ("d", "u2", "coupon", "2024-01-01 00:20:00"),
            ("d", None, "coupon", "2024-01-01 00:30:00")]
    assert _alert_ids(spark, rows) == []
    assert len(_alert_ids(spark, rows, count_null_uid=True)) == 6


def test_alert_pane_form_equals_native_window(spark):
    rows = [("d", f"u{i % 4}", ["coupon", "addCart", "coupon", "clickItem", "coupon"][i % 5],
             f"2024-01-01 {i % 24:02d}:{(i * 7) % 60:02d}:00") for i in range(60)]
    ev = events(spark, rows)
    pane = {(r.id, tuple(r.uids), tuple(r.events)) for r in alerts.coupon_alerts(ev, H6, H1).collect()}
    nat = alerts.windowed_alerts(ev.withColumn("event_time", F.timestamp_millis("ts_ms")),
                                 "6 hours", "1 hour").where("ok")
    native = {(r.id, tuple(r.uids), tuple(r.events)) for r in nat.collect()}
    assert pane == native


def test_phone_masking(spark):
    df = spark.createDataFrame([("12345",), ("13812345678",), (None,)], "tel string")
    got = [r.m for r in df.select(mask_phone("tel").alias("m")).collect()]
    assert got == ["*******", "*******5678", None]


def test_datetime_split_and_missing_time(spark):
    df = spark.createDataFrame([("2024-01-02 13:04:05",), ("2024-01-02",)], "t string")
    got = [(r.d, r.h) for r in df.select(datetime_date("t").alias("d"), datetime_hour("t").alias("h")).collect()]
    assert got == [("2024-01-02", "13"), ("2024-01-02", "")]


def test_age_in_365_day_years(spark):
    df = spark.createDataFrame([("2000-08-02",), ("2000-08-03",), ("1990-01-01",)], "b string")
    got = [r.a for r in df.select(age_years("b", "2001-08-02").alias("a")).collect()]
    assert got == [1, 0, 11]


def test_percent_half_up(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 0)], "p long, t long")
    got = [r.v for r in df.select(percent_1dp("p", "t").alias("v")).collect()]
    assert got == [33.3, 66.7, 12.5, None]


def _order_line_user(spark):
    o = spark.createDataFrame([("1", "O", "2024-01-01 10:00:00", "7", "2024-01-01"),
                               ("2", "F", "2024-01-01 11:00:00", "8", "2024-01-01")],
                              "id string, order_status string, create_time string, user_id string, create_date string")
    d = spark.createDataFrame([("1_1", "1", "s1", "red widget", "10.5", "2"),
                               ("1_2", "1", "s2", "blue widget", "3.0", "1"),
                               ("9_1", "9", "s3", "lonely bolt", "1.0", "1")],
                              "id string, order_id string, sku_id string, sku_name string, order_price string, sku_num string")
    u = spark.createDataFrame([("8", "L", "M", "2000-08-02")], "id string, user_level string, gender string, birthday string")
    return o, d, u


def test_sale_detail_unknown_user_defaults(spark):
    o, d, u = _order_line_user(spark)
    rows = {r.order_detail_id: r for r in sales.sale_detail(o, d, u, "2001-08-02").collect()}
    assert set(rows) == {"1_1", "1_2"}
    r = rows["1_1"]
    assert (r.user_age, r.user_gender, r.user_level, r.sku_price, r.dt) == (0, None, None, 10.5, "2024-01-01")


def test_unmatched_dead_letters(spark):
    o, d, _ = _order_line_user(spark)
    got = sorted((r.side, r.id) for r in sales.unmatched(o, d).collect())
    assert got == [("order", "2"), ("order_detail", "9_1")]


def test_search_and_shares(spark):
    o, d, u = _order_line_user(spark)
    sd = sales.sale_detail(o, d, u, "2001-08-02")
    m = search.search(sd, "2024-01-01", "Widget")
    assert m.count() == 2
    assert search.search(sd, "2024-01-01", "").count() == 0
    assert search.search(sd, "2024-01-01", "red widget").count() == 1
    shares = {r.name: r.value for r in search.gender_share(m).collect()}
    assert list(shares.values()) == [0.0, 0.0]  # no user known: neither M nor F, no error
    ages = [r.value for r in search.age_share(m).collect()]
    assert ages == [100.0, 0.0, 0.0]  # unknown users are age 0 -> under 20
    page = search.page(m, 2, 1).collect()
    assert [r.order_detail_id for r in page] == ["1_2"]
    assert search.page_from_offset(10, 10) == 2


def test_empty_day_dashboard(spark):
    vals = spark.createDataFrame([("2024-01-02", "05", 1.5)], "create_date string, create_hour string, sum_amount double")
    rows = dashboard.hour_compare(vals, "create_date", "create_hour", "sum_amount", date="2030-01-01", zero=0.0).collect()
    assert len(rows) == 24 and all(r.today == 0.0 and r.yesterday == 0.0 for r in rows)
    rows = dashboard.hour_compare(vals, "create_date", "create_hour", "sum_amount", date="2024-01-03", zero=0.0).collect()
    assert {r.hour: r.yesterday for r in rows}["05"] == 1.5
    empty_o = spark.createDataFrame([], "create_date string, sum_amount double")
    empty_d = spark.createDataFrame([], "logdate string, ct long")
    cards = {r.id: r.value for r in dashboard.metric_cards(empty_d, empty_d, empty_o, date="2030-01-01").collect()}
    assert cards == {"dau": 0.0, "newMid": 0.0, "order_amount": None}


def test_log_routing_and_stamp(spark):
    raw = spark.createDataFrame([('{"type":"startup","mid":"m1"}',), ('{}',), ('{"type":"event","evid":"coupon"}',)],
                                "value string")
    out = ingest.route_logs(ingest.stamp_logs(raw, stamp=123)).collect()
    assert [r.topic for r in out] == [TOPIC_STARTUP, TOPIC_EVENT, TOPIC_EVENT]
    assert out[0].value == '{"type":"startup","mid":"m1","ts":123}'
    assert out[1].value == '{"ts":123}'


def test_change_routing_drops_updates_and_deletes(spark):
    schema = "entry_type string, table string, op string, rows array<map<string,string>>, seq long"
    rows = [("ROWDATA", "order_info", "INSERT", [{"id": "1"}], 1),
            ("ROWDATA", "order_info", "UPDATE", [{"id": "1"}], 2),
            ("ROWDATA", "order_info", "DELETE", [{"id": "1"}], 3),
            ("ROWDATA", "user_info", "UPDATE", [{"id": "5", "user_level": "2"}], 4),
            ("ROWDATA", "user_info", "DELETE", [{"id": "5"}], 5),
            ("TRANSACTIONEND", None, None, [], 6),
            ("ROWDATA", "order_detail", "INSERT", [{"id": "1_1"}, {"id": "1_2"}], 7)]
    got = [(r.topic, json.loads(r.value)) for r in ingest.route_changes(spark.createDataFrame(rows, schema)).collect()]
    key = lambda x: (x[0], sorted(x[1].items()))
    assert sorted(got, key=key) == sorted([(TOPIC_ORDER, {"id": "1"}), (TOPIC_USER, {"id": "5", "user_level": "2"}),
                                           ("ORDER_DETAIL", {"id": "1_1"}), ("ORDER_DETAIL", {"id": "1_2"})],
                                          key=key)


def test_epoch_millis_ignores_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        assert df.select(epoch_millis_ntz("t").alias("m")).first().m == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_order_info_shape(spark):
    rows = spark.createDataFrame([("1", "13812345678", "2024-01-01 10:11:12", 5.25)],
                                 "id string, consignee_tel string, create_time string, total_amount double")
    r = orders.order_info(rows).first()
    assert len(r) == 20 and r.consignee_tel == "*******5678" and r.create_hour == "10"


def test_level_filter_and_result_row(spark):
    o, d, u = _order_line_user(spark)
    sd = sales.sale_detail(o, d, u, "2001-08-02")
    assert search.search(sd, "2024-01-01", "widget", level="L").count() == 0
    assert search.search(sd, None, "bolt").count() == 0  # line 9_1 has no order
    r = search.result(search.search(sd, "2024-01-01", "widget"), 1, 5).first()
    assert r.total == 2 and len(r.detail) == 2
    assert sorted(g.title for g in r.stat) == sorted(["性别占比", "年龄占比"])


def test_alert_list_for_one_day(spark):
    rows = [("d", f"u{i}", "coupon", f"2024-01-01 0{i}:10:00") for i in range(3)]
    al = alerts.coupon_alerts(events(spark, rows), H6, H1)
    assert alerts.for_day(al, "2024-01-01").count() + alerts.for_day(al, "2024-01-02").count() == al.count()


@pytest.mark.parametrize("window_min,slide_min", [(90, 60), (60, 60), (45, 20)])
def test_alert_panes_match_native_window_for_odd_sizes(spark, window_min, slide_min):
    rows = [(f"d{i % 2}", f"u{i % 5}", ["coupon", "addCart", "coupon", "coupon", "clickItem", "coupon"][i % 6],
             f"2024-01-01 {(i * 7) % 24:02d}:{(i * 13) % 60:02d}:{i % 60:02d}") for i in range(120)]
    ev = events(spark, rows)
    w, s = window_min * 60_000, slide_min * 60_000
    pane = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(r.events))
            for r in alerts.coupon_alerts(ev, w, s, min_users=2).collect()}
    nat = alerts.windowed_alerts(ev.withColumn("event_time", F.timestamp_millis("ts_ms")),
                                 f"{window_min} minutes", f"{slide_min} minutes", min_users=2).where("ok")
    native = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(r.events)) for r in nat.collect()}
    assert pane and pane == native


def test_small_scalar_functions(spark):
    from livemart.functions.shape import value_band
    from livemart.functions.timefmt import date_or_today, millis_to_text, previous_day
    df = spark.createDataFrame([("2024-03-01", 0), ("2024-01-01", 99), ("2023-12-31", 100), ("2024-02-29", 750)],
                               "d string, n long")
    got = [(r.p, r.b) for r in df.select(previous_day("d").alias("p"), value_band("n").alias("b")).collect()]
    assert got == [("2024-02-29", 0), ("2023-12-31", 0), ("2023-12-30", 1), ("2024-02-28", 5)]
    r = spark.range(1).select(date_or_today("2024-05-05").alias("a"), date_or_today(None).alias("b"),
                              millis_to_text(F.lit(_ms("2024-01-02 03:04:05"))).alias("c"),
                              millis_to_text(F.lit(_ms("2024-01-02 03:04:05")), "Asia/Shanghai").alias("s")).first()
    assert r.a == "2024-05-05" and len(r.b) == 10
    assert r.c == "2024-01-02 03:04:05" and r.s == "2024-01-02 11:04:05"


def test_hour_map_rows_to_map(spark):
    vals = spark.createDataFrame([("d1", "01", 3), ("d1", "07", 4), ("d2", "00", 1)], "d string, h string, v long")
    got = {r.d: dict(r.m) for r in dashboard.hour_map(vals, "d", "h", "v").collect()}
    assert got == {"d1": {"01": 3, "07": 4}, "d2": {"00": 1}}


def test_malformed_logs_are_quarantined(spark):
    raw = spark.createDataFrame([('{"type":"startup","mid":"m1"}',), ('{"type":',), ('{"pgid":"x"}',), (None,)],
                                "value string")
    out = ingest.route_logs(ingest.stamp_logs(raw, stamp=5)).collect()
    assert [r.topic for r in out] == [TOPIC_STARTUP, "QUARANTINE", "QUARANTINE", "QUARANTINE"]
    assert out[1].value == '{"type":' and out[1].log is None
    assert out[0].value == '{"type":"startup","mid":"m1","ts":5}'


def test_hot_device_alerts_match_native_window(spark):
    from conftest import SF_SMALL
    from livemart.sources import adapters as A
    ev = A.event_logs(spark, SF_SMALL)
    # one device holds a third of all events
    ev = ev.withColumn("mid", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("mid")))
    w, s = 12 * 3600 * 1000, 3600 * 1000
    pane = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(r.events))
            for r in alerts.coupon_alerts(ev, w, s).collect()}
    nat = alerts.windowed_alerts(ev.withColumn("event_time", F.timestamp_millis("ts_ms")),
                                 "12 hours", "1 hour").where("ok")
    native = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(r.events)) for r in nat.collect()}
    assert pane == native and any(i.startswith("hot_") for i, *_ in pane)


def test_user_as_of_order_time(spark):
    sale_schema = ("order_detail_id string, order_id string, order_status string, create_time string, "
                   "user_id string, sku_id string, sku_price double, sku_name string, dt string, sku_num string, "
                   "order_ms long")
    s = spark.createDataFrame([("a", "1", "O", "x", "7", "s", 1.0, "n", "d", "1", 50),
                               ("b", "1", "O", "x", "7", "s", 1.0, "n", "d", "1", 150),
                               ("c", "1", "O", "x", "7", "s", 1.0, "n", "d", "1", 250),
                               ("d", "1", "O", "x", "8", "s", 1.0, "n", "d", "1", 250)], sale_schema)
    ch = spark.createDataFrame([("7", "L1", "2000-08-02", "F", 1, 100), ("7", "L2", "2000-08-02", "F", 2, 200),
                                ("7", "L3", "2000-08-02", "F", 3, 200)],
                               "id string, user_level string, birthday string, gender string, seq long, change_ms long")
    got = {r.order_detail_id: (r.user_level, r.user_age) for r in sales.with_user_as_of(s, ch, "2001-08-02").collect()}
    assert got == {"a": (None, 0), "b": ("L1", 1), "c": ("L3", 1), "d": (None, 0)}


def test_alert_window_must_cover_its_slide(spark):
    with pytest.raises(ValueError):
        alerts.coupon_alerts(events(spark, [("d", "u1", "coupon", "2024-01-01 00:10:00")]), H1, H6)


def test_age_bands_count_every_age(spark):
    m = spark.range(150).select(F.col("id").cast("int").alias("user_age"), F.lit("M").alias("user_gender"))
    shares = {r.name: r.value for r in search.age_share(m).collect()}
    assert list(shares.values()) == [13.3, 6.7, 80.0]
