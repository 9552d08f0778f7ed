"""SQL oracles: for each registered query, the same result in plain SQL.

Written for DuckDB over the input tables (views named after the tables); the
checker runs these next to the Spark queries and compares the results.
They restate the definitions of FIXTURES.md §2 independently of the Spark
code, so they are written table-first rather than operator-first.
"""

from __future__ import annotations

from livemart.plans import params as P

LOGS = """
lg AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms,
         CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END AS type,
         'mid_' || CAST((user_id // 20) * 2 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 AS VARCHAR) AS mid,
         CAST(user_id AS VARCHAR) AS uid,
         'livemart' AS appid,
         'area_' || CAST(user_id % 10 AS VARCHAR) AS area,
         CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os,
         CASE WHEN user_id % 2 = 0 THEN 'appstore' ELSE 'ch_' || CAST(user_id % 7 AS VARCHAR) END AS ch,
         '1.1.' || CAST(user_id % 4 AS VARCHAR) AS vs,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
                         WHEN 'view' THEN 'addCart' WHEN 'error' THEN 'addComment' END AS evid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%d') AS logdate, strftime(ts, '%H') AS loghour
  FROM events)"""

DAU = LOGS + """,
dau AS (
  SELECT mid, uid, appid, area, os, ch, type, vs, logdate, loghour, ts_ms AS ts FROM (
    SELECT *, row_number() OVER (PARTITION BY logdate, mid ORDER BY ts_ms, event_id) AS rn
    FROM lg WHERE type = 'startup') WHERE rn = 1)"""

CREATE_TIME = ("strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), "
               "'%Y-%m-%d %H:%M:%S')")

ORDERS = f"""
ord AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS order_status,
         CAST(o_custkey AS VARCHAR) AS user_id, o_totalprice AS total_amount,
         {CREATE_TIME} AS create_time,
         split_part({CREATE_TIME}, ' ', 1) AS create_date,
         split_part(split_part({CREATE_TIME}, ' ', 2), ':', 1) AS create_hour
  FROM orders)"""

LINES = """
det AS (
  SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_detail_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         p_name AS sku_name, p_retailprice AS sku_price,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

# users reach the dimension through the change router: inserts (key mod 3 = 0)
# and updates (= 1) are routed, deletes (= 2) are dropped
USERS = """
usr AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
  FROM customer WHERE c_custkey % 3 IN (0, 1))"""

SALES = ORDERS + "," + LINES + "," + USERS + f""",
sale AS (
  SELECT d.order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
         u.gender AS user_gender,
         CAST(coalesce(floor(date_diff('day', CAST(u.birthday AS DATE), DATE '{P.AS_OF}') / 365), 0) AS INTEGER) AS user_age,
         u.user_level, d.sku_price, d.sku_name, o.create_date AS dt, d.sku_num
  FROM ord o JOIN det d ON d.order_id = o.id LEFT JOIN usr u ON u.id = o.user_id)"""

TOKENS = r"regexp_extract_all(lower(sku_name), '\p{Han}|(?:[^\P{L}\p{Han}]|\p{N})+')"

MATCHED = SALES + f""",
q AS (SELECT list_distinct({TOKENS.replace('sku_name', "'" + P.SEARCH_KEYWORD + "'")}) AS terms),
matched AS (
  SELECT s.*, CAST(len(list_filter({TOKENS}, lambda t: list_contains(q.terms, t))) AS INTEGER) AS score
  FROM sale s, q
  WHERE s.dt = '{P.SEARCH_DATE}' AND len(q.terms) > 0 AND list_has_all({TOKENS}, q.terms))"""


def pct(part: str, total: str) -> str:
    return (f"CASE WHEN {total} = 0 THEN CAST(0 AS DOUBLE) ELSE "
            f"floor(CAST({part} AS DOUBLE) * CAST(1000 AS DOUBLE) / CAST({total} AS DOUBLE) "
            f"+ CAST(0.5 AS DOUBLE)) / CAST(10 AS DOUBLE) END")


def hour_compare(values_cte: str, date: str, hour: str, value: str, zero: str) -> str:
    return f"""
days AS (SELECT DISTINCT {date} AS d FROM {values_cte}),
spine AS (SELECT d, lpad(CAST(h.range AS VARCHAR), 2, '0') AS hour FROM days CROSS JOIN range(24) h)
SELECT s.d AS {date}, s.hour, coalesce(t.{value}, {zero}) AS today, coalesce(y.{value}, {zero}) AS yesterday
FROM spine s
LEFT JOIN {values_cte} t ON t.{date} = s.d AND t.{hour} = s.hour
LEFT JOIN {values_cte} y ON y.{date} = strftime(CAST(s.d AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AND y.{hour} = s.hour"""


def alerts_sql(window_ms: int, slide_ms: int, divisor: int = 1) -> str:
    return LOGS + f""",
ev AS (SELECT mid, uid, evid, CAST(k AS VARCHAR) AS itemid, ts_ms // {divisor} AS ts_ms, event_id
       FROM lg WHERE type = 'event'),
win AS (SELECT ev.*, (ts_ms - ts_ms % {slide_ms}) - r.range * {slide_ms} AS wstart
        FROM ev CROSS JOIN range({window_ms // slide_ms}) r),
g AS (
  SELECT mid, wstart,
         list_sort(list(DISTINCT uid) FILTER (WHERE evid = 'coupon')) AS uids,
         list_sort(list(DISTINCT itemid) FILTER (WHERE evid = 'coupon')) AS items,
         bool_or(evid = 'clickItem') AS clicked,
         string_agg(evid, ',' ORDER BY ts_ms, event_id) AS events
  FROM win GROUP BY mid, wstart),
alerts AS (
  SELECT mid || '_' || CAST((wstart + {window_ms}) // 60000 AS VARCHAR) AS id, mid,
         array_to_string(uids, ',') AS uids, array_to_string(items, ',') AS itemIds, events,
         wstart + {window_ms} AS ts,
         strftime(make_timestamp(wstart * 1000), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(make_timestamp((wstart + {window_ms}) * 1000), '%Y-%m-%d %H:%M:%S') AS window_end
  FROM g WHERE len(uids) >= {P.ALERT_MIN_USERS} AND NOT clicked)"""


ALERTS = alerts_sql(P.ALERT_WINDOW_MS, P.ALERT_SLIDE_MS)
LIVE_ALERTS = alerts_sql(P.LIVE_WINDOW_MS, P.LIVE_SLIDE_MS, P.LIVE_DIVISOR)

LATEST_PER_MINUTE = """
SELECT id, mid, uids, itemIds, events, ts, window_start, window_end FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, window_start DESC) AS rn FROM alerts)
WHERE rn = 1"""


def _startup_json() -> str:
    return ("json_object('type', type, 'mid', mid, 'uid', uid, 'os', os, 'appid', appid, "
            "'area', area, 'ch', ch, 'vs', vs, 'ts', ts_ms)")


def _event_json() -> str:
    return ("json_object('type', type, 'mid', mid, 'uid', uid, 'os', os, 'appid', appid, "
            "'area', area, 'evid', evid, 'pgid', k % 50 + 1, 'npgid', (k + 1) % 50 + 1, "
            "'itemid', CAST(k AS VARCHAR), 'ts', ts_ms)")


ORACLE_SQL: dict[str, str] = {
    "log_route": f"""WITH {LOGS}
SELECT event_id,
       CASE WHEN type = 'startup' THEN 'STARTUP' ELSE 'EVENT' END AS topic,
       CAST(CASE WHEN type = 'startup' THEN {_startup_json()} ELSE {_event_json()} END AS VARCHAR) AS value
FROM lg""",

    "log_date_hour": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS logdate, strftime(ts, '%H') AS loghour
FROM events""",

    "log_json_roundtrip": f"""WITH {LOGS}
SELECT event_id, type, mid, uid, os, appid, area,
       CASE WHEN type = 'startup' THEN ch END AS ch,
       CASE WHEN type = 'startup' THEN vs END AS vs,
       evid,
       CASE WHEN type = 'event' THEN k % 50 + 1 END AS pgid,
       CASE WHEN type = 'event' THEN (k + 1) % 50 + 1 END AS npgid,
       CASE WHEN type = 'event' THEN CAST(k AS VARCHAR) END AS itemid,
       ts_ms AS ts
FROM lg""",

    "log_type_route": """SELECT event_id, CASE WHEN event_type = 'signup' THEN 'STARTUP' ELSE 'EVENT' END AS topic
FROM events""",

    "cdc_route": """
SELECT 'ORDER' AS topic,
       CAST(json_object('id', CAST(o_orderkey AS VARCHAR), 'user_id', CAST(o_custkey AS VARCHAR),
                        'order_status', o_orderstatus, 'total_amount', CAST(o_totalprice AS VARCHAR)) AS VARCHAR) AS value
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT 'ORDER_DETAIL',
       CAST(json_object('id', concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey),
                        'order_id', CAST(l_orderkey AS VARCHAR), 'sku_id', CAST(l_partkey AS VARCHAR)) AS VARCHAR)
FROM lineitem WHERE (l_orderkey + l_linenumber) % 3 = 0
UNION ALL
SELECT 'USER', CAST(json_object('id', CAST(c_custkey AS VARCHAR), 'login_name', c_name, 'user_level', c_mktsegment,
                                'birthday', strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d'),
                                'gender', CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END) AS VARCHAR)
FROM customer WHERE c_custkey % 3 IN (0, 1)""",

    "dau_first": f"WITH {DAU} SELECT * FROM dau",

    "dau_new_vs_seen": f"""WITH {LOGS},
seen AS (SELECT DISTINCT logdate, mid FROM lg WHERE type = 'startup' AND loghour < '{P.SEEN_BEFORE_HOUR}'),
fresh AS (SELECT * FROM lg l WHERE type = 'startup' AND loghour >= '{P.SEEN_BEFORE_HOUR}'
          AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.logdate = l.logdate AND s.mid = l.mid))
SELECT mid, uid, appid, area, os, ch, type, vs, logdate, loghour, ts_ms AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY logdate, mid ORDER BY ts_ms, event_id) AS rn FROM fresh)
WHERE rn = 1""",

    "dau_total": f"WITH {DAU} SELECT logdate, count(*) AS ct FROM dau GROUP BY logdate",

    "dau_hour": f"WITH {DAU} SELECT logdate, loghour, count(*) AS ct FROM dau GROUP BY logdate, loghour",

    "dau_hour_compare": f"""WITH {DAU},
v AS (SELECT logdate, loghour, count(*) AS ct FROM dau GROUP BY logdate, loghour),
{hour_compare('v', 'logdate', 'loghour', 'ct', '0')}""",

    "new_devices": f"""WITH {LOGS}
SELECT logdate, count(*) AS ct FROM (
  SELECT mid, min(logdate) AS logdate FROM lg WHERE type = 'startup' GROUP BY mid)
GROUP BY logdate""",

    "order_masked": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS province_id,
       CAST(NULL AS VARCHAR) AS consignee, CAST(NULL AS VARCHAR) AS order_comment,
       CASE WHEN c_custkey IS NULL THEN NULL
            ELSE '*******' || substring('1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 8) END AS consignee_tel,
       o_orderstatus AS order_status, CAST(NULL AS VARCHAR) AS payment_way,
       CAST(o_custkey AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS img_url,
       o_totalprice AS total_amount, CAST(NULL AS VARCHAR) AS expire_time,
       CAST(NULL AS VARCHAR) AS delivery_address, {CREATE_TIME} AS create_time,
       CAST(NULL AS VARCHAR) AS operate_time, CAST(NULL AS VARCHAR) AS tracking_no,
       CAST(NULL AS VARCHAR) AS parent_order_id, CAST(NULL AS VARCHAR) AS out_trade_no,
       CAST(NULL AS VARCHAR) AS trade_body,
       split_part({CREATE_TIME}, ' ', 1) AS create_date,
       split_part(split_part({CREATE_TIME}, ' ', 2), ':', 1) AS create_hour
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",

    "order_amount_total": f"""WITH {ORDERS}
SELECT create_date, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount
FROM ord GROUP BY create_date""",

    "order_amount_hour": f"""WITH {ORDERS}
SELECT create_date, create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount
FROM ord GROUP BY create_date, create_hour""",

    "order_amount_hour_compare": f"""WITH {ORDERS},
v AS (SELECT create_date, create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount
      FROM ord GROUP BY create_date, create_hour),
{hour_compare('v', 'create_date', 'create_hour', 'sum_amount', 'CAST(0 AS DOUBLE)')}""",

    "metric_cards": f"""WITH {DAU}, {ORDERS},
dd AS (SELECT logdate AS date, count(*) AS ct FROM dau GROUP BY logdate),
nd AS (SELECT logdate AS date, count(*) AS ct FROM (
         SELECT mid, min(logdate) AS logdate FROM lg WHERE type = 'startup' GROUP BY mid) GROUP BY logdate),
am AS (SELECT create_date AS date, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS v
       FROM ord GROUP BY create_date),
days AS (SELECT date FROM dd UNION SELECT date FROM nd UNION SELECT date FROM am)
SELECT days.date, 'dau' AS id, '新增日活' AS name, CAST(coalesce(dd.ct, 0) AS DOUBLE) AS value
FROM days LEFT JOIN dd ON dd.date = days.date
UNION ALL
SELECT days.date, 'newMid', '新增设备', CAST(coalesce(nd.ct, 0) AS DOUBLE)
FROM days LEFT JOIN nd ON nd.date = days.date
UNION ALL
SELECT days.date, 'order_amount', '新增交易额', am.v
FROM days LEFT JOIN am ON am.date = days.date""",

    "province_sales": """
SELECT CAST(c_nationkey AS VARCHAR) AS province_id, n_name AS province, count(*) AS cnt,
       CAST(least(floor(count(*) / 100), 5) AS INTEGER) AS band
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
GROUP BY c_nationkey, n_name""",

    "user_latest": f"WITH {USERS} SELECT id, login_name, user_level, birthday, gender, CAST(2 AS BIGINT) AS seq FROM usr",

    "sale_detail": f"WITH {SALES} SELECT * FROM sale",

    "sale_unmatched": """WITH det AS (
  SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_detail_id,
         CAST(l_orderkey AS VARCHAR) AS order_id FROM lineitem)
SELECT 'order' AS side, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS order_id
FROM orders WHERE NOT EXISTS (SELECT 1 FROM det WHERE det.order_id = CAST(o_orderkey AS VARCHAR))
UNION ALL
SELECT 'order_detail', order_detail_id, order_id FROM det
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderkey AS VARCHAR) = det.order_id)""",

    "sale_search_page": f"""WITH {MATCHED}
SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age,
       user_level, sku_price, sku_name, dt, sku_num, score
FROM matched ORDER BY score DESC, order_detail_id
LIMIT {P.PAGE_SIZE} OFFSET {(P.PAGE_NO - 1) * P.PAGE_SIZE}""",

    "sale_total": f"WITH {MATCHED} SELECT count(*) AS total FROM matched",

    "sale_gender_topk": f"""WITH {MATCHED}
SELECT user_gender, count(*) AS cnt FROM matched WHERE user_gender IS NOT NULL
GROUP BY user_gender ORDER BY cnt DESC, user_gender LIMIT 2""",

    "sale_age_topk": f"""WITH {MATCHED}
SELECT user_age, count(*) AS cnt FROM matched WHERE user_age IS NOT NULL
GROUP BY user_age ORDER BY cnt DESC, user_age LIMIT 100""",

    "sale_gender_share": f"""WITH {MATCHED},
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE user_gender = 'M') AS m,
             count(*) FILTER (WHERE user_gender = 'F') AS f FROM matched)
SELECT '性别占比' AS title, '男' AS name, {pct('m', 'n')} AS value FROM a
UNION ALL
SELECT '性别占比', '女', {pct('f', 'n')} FROM a""",

    "sale_age_share": f"""WITH {MATCHED},
ages AS (SELECT user_age, count(*) AS cnt FROM matched GROUP BY user_age),
ranked AS (SELECT *, CASE WHEN user_age < 20 THEN '20岁以下' WHEN user_age < 30 THEN '20岁到30岁'
                       ELSE '30岁以上' END AS band FROM ages),
tot AS (SELECT coalesce(sum(cnt), 0) AS n FROM ranked),
b AS (SELECT band, sum(cnt) AS c FROM ranked GROUP BY band),
labels AS (SELECT * FROM (VALUES ('20岁以下'), ('20岁到30岁'), ('30岁以上')) t(name))
SELECT '年龄占比' AS title, labels.name, {pct('coalesce(b.c, 0)', 'tot.n')} AS value
FROM labels CROSS JOIN tot LEFT JOIN b ON b.band = labels.name""",

    "sale_facets": f"""WITH {MATCHED},
banded AS (SELECT user_gender,
                  CASE WHEN user_age < 20 THEN '20岁以下' WHEN user_age < 30 THEN '20岁到30岁'
                       ELSE '30岁以上' END AS age_band FROM matched),
g AS (SELECT user_gender, age_band, grouping(user_gender) AS gg, grouping(age_band) AS ga, count(*) AS cnt
      FROM banded GROUP BY GROUPING SETS ((user_gender), (age_band), ()))
SELECT CASE WHEN gg = 0 THEN 'gender' WHEN ga = 0 THEN 'age_band' ELSE 'total' END AS facet,
       CASE WHEN gg = 0 THEN user_gender WHEN ga = 0 THEN age_band END AS key, cnt
FROM g WHERE NOT (gg = 0 AND user_gender IS NULL)""",

    "sale_search_result": f"""WITH {MATCHED},
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE user_gender = 'M') AS m,
             count(*) FILTER (WHERE user_gender = 'F') AS f FROM matched),
ages AS (SELECT user_age, count(*) AS cnt FROM matched GROUP BY user_age),
ranked AS (SELECT *, CASE WHEN user_age < 20 THEN '20岁以下' WHEN user_age < 30 THEN '20岁到30岁'
                       ELSE '30岁以上' END AS band FROM ages),
tot AS (SELECT coalesce(sum(cnt), 0) AS n FROM ranked),
b AS (SELECT band, sum(cnt) AS c FROM ranked GROUP BY band),
labels AS (SELECT * FROM (VALUES (1, '20岁以下'), (2, '20岁到30岁'), (3, '30岁以上')) t(ord, name)),
bands AS (SELECT labels.ord, labels.name, {pct('coalesce(b.c, 0)', 'tot.n')} AS value
          FROM labels CROSS JOIN tot LEFT JOIN b ON b.band = labels.name),
pg AS (SELECT * FROM matched ORDER BY score DESC, order_detail_id
       LIMIT {P.PAGE_SIZE} OFFSET {(P.PAGE_NO - 1) * P.PAGE_SIZE})
SELECT a.n AS total,
       CAST(to_json([
         {{'title': '性别占比', 'options': [{{'name': '男', 'value': {pct('a.m', 'a.n')}}},
                                            {{'name': '女', 'value': {pct('a.f', 'a.n')}}}]}},
         {{'title': '年龄占比', 'options': (SELECT list({{'name': name, 'value': value}} ORDER BY ord) FROM bands)}}
       ]) AS VARCHAR) AS stat_json,
       CASE WHEN (SELECT count(*) FROM pg) = 0 THEN '[]' ELSE
       CAST(to_json((SELECT list({{'order_detail_id': order_detail_id, 'order_id': order_id,
                                  'order_status': order_status, 'create_time': create_time, 'user_id': user_id,
                                  'sku_id': sku_id, 'user_gender': user_gender, 'user_age': user_age,
                                  'user_level': user_level, 'sku_price': sku_price, 'sku_name': sku_name,
                                  'dt': dt, 'sku_num': sku_num}} ORDER BY score DESC, order_detail_id)
                     FROM pg)) AS VARCHAR) END AS detail_json
FROM a""",

    "coupon_alert_windows": f"WITH {ALERTS} SELECT * FROM alerts",

    "coupon_alert_minute": f"WITH {ALERTS} {LATEST_PER_MINUTE}",

    "coupon_alert_day": f"""WITH {ALERTS},
per_minute AS ({LATEST_PER_MINUTE})
SELECT * FROM per_minute WHERE window_end LIKE '{P.DASH_DATE}%'""",

    "coupon_alert_30s": f"WITH {LIVE_ALERTS} SELECT * FROM alerts",

    "coupon_alert_30s_minute": f"WITH {LIVE_ALERTS} {LATEST_PER_MINUTE}",
}

ORACLE_SQL["dau_hour_map"] = f"""WITH hc AS ({ORACLE_SQL['dau_hour']})
SELECT logdate, string_agg(loghour || ':' || CAST(ct AS VARCHAR), ',' ORDER BY loghour) AS hours
FROM hc GROUP BY logdate"""
ORACLE_SQL["dau_hour_day"] = f"""SELECT * FROM ({ORACLE_SQL['dau_hour_compare']}) WHERE logdate = '{P.DASH_DATE}'"""
TODAY = "strftime(current_timestamp AT TIME ZONE 'UTC', '%Y-%m-%d')"
ORACLE_SQL["dau_hour_today"] = f"""WITH {DAU},
v AS (SELECT logdate, loghour, count(*) AS ct FROM dau GROUP BY logdate, loghour),
hours AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM range(24) t(h))
SELECT {TODAY} AS logdate, hour,
       CAST(coalesce((SELECT sum(ct) FROM v WHERE loghour = hour AND logdate = {TODAY}), 0) AS BIGINT) AS today,
       CAST(coalesce((SELECT sum(ct) FROM v WHERE loghour = hour
                      AND logdate = strftime(CAST({TODAY} AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d')), 0) AS BIGINT) AS yesterday
FROM hours"""
ORACLE_SQL["stream_dau_counts"] = f"""WITH {LOGS}
SELECT count(*) AS rows_in, count(DISTINCT logdate || ' ' || mid) AS rows_out FROM lg WHERE type = 'startup'"""
ORACLE_SQL["metric_cards_day"] = f"""WITH cards(id, name) AS (VALUES ('dau', '新增日活'), ('newMid', '新增设备'),
                                                   ('order_amount', '新增交易额'))
SELECT '{P.DASH_DATE}' AS date, cards.id, cards.name,
       CASE WHEN cards.id = 'order_amount' THEN c.value ELSE coalesce(c.value, 0) END AS value
FROM cards LEFT JOIN ({ORACLE_SQL['metric_cards']}) c ON c.id = cards.id AND c.date = '{P.DASH_DATE}'"""
ORACLE_SQL["sale_search_page2"] = f"""WITH {MATCHED}
SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age,
       user_level, sku_price, sku_name, dt, sku_num, score
FROM matched ORDER BY score DESC, order_detail_id LIMIT {P.PAGE_SIZE} OFFSET {P.PAGE2_OFFSET}"""
ORACLE_SQL["sale_search_level"] = f"""WITH {MATCHED}
SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age,
       user_level, sku_price, sku_name, dt, sku_num, score
FROM matched WHERE user_level = '{P.SEARCH_LEVEL}'"""


ORACLE_SQL["stream_log_route"] = f"""WITH {LOGS}
SELECT CASE WHEN type = 'startup' THEN 'STARTUP' ELSE 'EVENT' END AS topic, logdate,
       CAST(CASE WHEN type = 'startup' THEN {_startup_json()} ELSE {_event_json()} END AS VARCHAR) AS value
FROM lg"""

ORACLE_SQL["stream_documents"] = """WITH d AS (
  SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS VARCHAR) END AS id, lang, source, n_chars FROM documents)
SELECT id, lang, source, n_chars FROM d
UNION ALL SELECT id, lang, source, n_chars FROM d WHERE id IS NULL AND (doc_id % 10 = 0 OR doc_id % 7 = 1)"""

ORACLE_SQL["stream_sale_unmatched"] = """WITH det AS (
  SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey
  FROM lineitem WHERE l_orderkey % 9 <> 5 AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
SELECT 'order' AS side, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS order_id
FROM orders WHERE o_orderkey % 9 <> 4 AND NOT EXISTS (SELECT 1 FROM det WHERE l_orderkey = o_orderkey)
UNION ALL
SELECT 'order_detail', id, CAST(l_orderkey AS VARCHAR) FROM det WHERE l_orderkey % 9 = 4"""

ORACLE_SQL["sale_search_bm25"] = f"""WITH {SALES},
named AS (SELECT *, {TOKENS} AS toks FROM sale WHERE sku_name IS NOT NULL),
docs AS (SELECT * FROM named WHERE len(toks) > 0),
size AS (SELECT count(*) AS n, sum(len(toks)) / count(*) AS average FROM docs),
terms AS (SELECT DISTINCT unnest(string_split('{P.RELEVANCE_KEYWORD}', ' ')) AS term),
df AS (SELECT term, count(*) AS df FROM docs JOIN terms ON list_contains(toks, term) GROUP BY term),
hits AS (
  SELECT docs.* EXCLUDE (toks), df.df, len(toks) AS length, len(list_filter(toks, lambda x: x = term)) AS tf
  FROM docs JOIN df ON list_contains(toks, term) WHERE dt = '{P.SEARCH_DATE}'),
scored AS (
  SELECT order_detail_id, count(*) AS found,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))), 9) AS score
  FROM hits CROSS JOIN size GROUP BY order_detail_id)
SELECT docs.* EXCLUDE (toks), score FROM scored JOIN docs USING (order_detail_id)
WHERE found = (SELECT count(*) FROM terms)
ORDER BY score DESC, order_detail_id LIMIT {P.PAGE_SIZE}"""

# Streaming queries return the sink's latest view, which must equal the batch form.
STREAM_ORACLE_OF = {
    "stream_dau": "dau_first",
    "stream_alerts": "coupon_alert_windows",
    "stream_alerts_30s": "coupon_alert_30s_minute",
    "stream_user_dim": "user_latest",
    "stream_sale_detail": "sale_detail",
    "stream_sale_detail_late": "sale_detail",
    "stream_order_amount_hour": "order_amount_hour",
    "stream_user_late": "sale_detail",
    "stream_dau_late": "dau_first",
    "stream_cdc_route": "cdc_route",
    "sale_search_stored": "sale_search_result",
    "dau_hour_stored": "dau_hour_day",
    "stream_alerts_late": "coupon_alert_windows",
    "stream_metric_cards": "metric_cards",
    "stream_dau_seen": "dau_first",
    "stream_sale_restart": "sale_detail",
    "sale_search_indexed": "sale_search_result",
    "stream_dau_live": "dau_first",
}
ORACLE_SQL.update({k: ORACLE_SQL[v] for k, v in STREAM_ORACLE_OF.items()})
