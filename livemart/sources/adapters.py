"""Adapters: the driver's tables -> the records of the five input streams.

The upstream services emit client logs and change-data records; in this
repository they are derived from the given tables by column expressions and
joins (see FIXTURES.md §2), so every downstream operator has real volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livemart.functions.json import render
from livemart.functions.timefmt import epoch_millis_ntz
from livemart.sources.tables import read_table

# Fixed value: the number of users who share two devices.
USERS_PER_PAIR = 20


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client logs (start-ups and events) from ``events``.

    Columns: event_id, ts (timestamp_ntz), ts_ms, type, mid, uid, appid, area,
    os, ch, vs, evid, pgid, npgid, itemid, logdate, loghour.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id")
    ios = (uid % 2) == 0
    return ev.select(
        "event_id", "ts",
        epoch_millis_ntz("ts").alias("ts_ms"),
        F.when(F.col("event_type") == "signup", "startup").otherwise("event").alias("type"),
        F.concat(F.lit("mid_"), (F.floor(uid / USERS_PER_PAIR) * 2 + k % 2).cast("string")).alias("mid"),
        uid.cast("string").alias("uid"),
        F.lit("livemart").alias("appid"),
        F.concat(F.lit("area_"), (uid % 10).cast("string")).alias("area"),
        F.when(ios, "ios").otherwise("android").alias("os"),
        F.when(ios, "appstore").otherwise(F.concat(F.lit("ch_"), (uid % 7).cast("string"))).alias("ch"),
        F.concat(F.lit("1.1."), (uid % 4).cast("string")).alias("vs"),
        F.expr("CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem' "
               "WHEN 'view' THEN 'addCart' WHEN 'error' THEN 'addComment' END").alias("evid"),
        ((k % 50) + 1).alias("pgid"),
        (((k + 1) % 50) + 1).alias("npgid"),
        k.cast("string").alias("itemid"),
        F.date_format("ts", "yyyy-MM-dd").alias("logdate"),
        F.date_format("ts", "HH").alias("loghour"),
    )


def startup_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start-up logs only (topic STARTUP)."""
    return logs(spark, sf_dir).where(F.col("type") == "startup")


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event logs only (topic EVENT)."""
    return logs(spark, sf_dir).where(F.col("type") == "event")


def raw_log_json(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    """Raw client log text as the intake receives it: (event_id, ts, ts_ms, value).

    ``ts`` here is the client's time; the intake overwrites it (P7).  With
    ``with_arrival`` the text also carries ``ts`` = the recorded arrival time
    (epoch ms), as a replay of stamped logs does.
    """
    lg = logs(spark, sf_dir)
    arrival = [F.col("ts_ms").alias("ts")] if with_arrival else []
    startup = render("type", "mid", "uid", "os", "appid", "area", "ch", "vs", *arrival)
    event = render("type", "mid", "uid", "os", "appid", "area", "evid", "pgid", "npgid", "itemid",
                   *arrival)
    return lg.select("event_id", "ts", "ts_ms",
                     F.when(F.col("type") == "startup", startup).otherwise(event).alias("value"))


def _create_time() -> F.Column:
    offset = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") * 7919) % 86400)
    return F.date_format(F.col("o_orderdate") + offset, "yyyy-MM-dd HH:mm:ss")


def order_rows(spark: SparkSession, sf_dir: str, with_customer: bool = True,
               day: str | None = None) -> DataFrame:
    """Raw order-info rows (unmasked, no derived date/hour), from ``orders``.

    ``day`` lets the scan skip row groups that cannot hold orders created on
    that day: the creation time is at most a day after ``o_orderdate``.  The
    caller still filters on the derived date.

    ``with_customer`` joins ``customer`` for the province and phone; consumers
    that need neither (the sale join) skip that shuffle.
    """
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    if day is not None:
        start = F.to_timestamp_ntz(F.lit(day))
        o = o.where((F.col("o_orderdate") >= start - F.expr("INTERVAL 1 DAY"))
                    & (F.col("o_orderdate") < start + F.expr("INTERVAL 1 DAY")))
    base = o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        _create_time().alias("create_time"),
    )
    if not with_customer:
        return base.drop("o_custkey")
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    # left join: an order whose customer is not replicated keeps null province/phone
    joined = base.join(c, base.o_custkey == c.c_custkey, "left")
    return joined.select(
        "id",
        F.col("c_nationkey").cast("string").alias("province_id"),
        F.concat(F.lit("1"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("consignee_tel"),
        "order_status", "user_id", "total_amount", "create_time",
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines (all values strings, as change records carry them)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_retailprice"])
    j = li.join(p, li.l_partkey == p.p_partkey, "left")  # a line of an unknown part stays
    return j.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("p_retailprice").cast("string").alias("order_price"),
        F.lit(None).cast("string").alias("img_url"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
    )


def order_detail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-line keys only, (id, order_id), straight from ``lineitem``.

    For consumers that need no line attributes (dead-letter detection): the
    part lookup that fills ``sku_name`` would cost a shuffle of every line.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return li.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"))


def _birthday() -> F.Column:
    return F.date_format(
        F.date_add(F.to_date(F.lit("1950-01-01")), ((F.col("c_custkey") * 37) % 18000).cast("int")),
        "yyyy-MM-dd")


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension rows: the ``user_info`` change records after the router.

    The change-data router (F1 + F2) sends inserts and updates of users to
    the user topic and drops deletes, so users whose only change is a delete
    never reach the dimension -- the sale join's user lookup has real misses.
    The routed JSON after-images are parsed back into user rows (P3 + P1).
    """
    from livemart.operators.ingest import route_changes
    from livemart.schemas import TOPIC_USER, USER_INFO
    routed = route_changes(user_change_entries(spark, sf_dir)).where(F.col("topic") == TOPIC_USER)
    rec = F.from_json("value", USER_INFO)
    return routed.select(rec.alias("u")).select("u.*")


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User change log: two versions per user (seq 1 = first insert, seq 2 = update).

    Version 1 carries a placeholder level; version 2 the current row.  Rows
    are emitted in (seq desc) order per file so arrival order != change order.
    """
    cur = user_info(spark, sf_dir)
    versions = F.array(F.struct(F.lit(2).cast("bigint").alias("seq"), F.col("user_level")),
                       F.struct(F.lit(1).cast("bigint").alias("seq"), F.lit("NEW").alias("user_level")))
    return (cur.select("id", "login_name", "birthday", "gender", F.explode(versions).alias("v"))
               .select("id", "login_name", "v.user_level", "birthday", "gender", "v.seq"))


def _op(key) -> F.Column:
    """Operation of a change row: key mod 3 -> INSERT, UPDATE, DELETE."""
    return F.element_at(F.array(F.lit("INSERT"), F.lit("UPDATE"), F.lit("DELETE")),
                        (key % 3 + 1).cast("int"))


def user_change_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-data entries of the ``user_info`` table, one per customer.

    Each carries the whole user record as its after-image (all values
    strings); the operation is key mod 3.
    """
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return c.select(
        F.lit("ROWDATA").alias("entry_type"), F.lit("user_info").alias("table"),
        _op(F.col("c_custkey")).alias("op"),
        F.array(F.create_map(
            F.lit("id"), F.col("c_custkey").cast("string"),
            F.lit("login_name"), F.col("c_name"),
            F.lit("user_level"), F.col("c_mktsegment"),
            F.lit("birthday"), _birthday(),
            F.lit("gender"), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M"))).alias("rows"),
        F.col("c_custkey").alias("seq"),
    )


def change_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-data entries built from orders, lineitem and customer.

    The operation of each row is key mod 3 (INSERT, UPDATE, DELETE); every
    order also opens a transaction, giving one TRANSACTIONBEGIN marker.
    Columns follow ``schemas.CHANGE_RECORD`` (without change_ts).
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    orders = o.select(
        F.lit("ROWDATA").alias("entry_type"), F.lit("order_info").alias("table"),
        _op(F.col("o_orderkey")).alias("op"),
        F.array(F.create_map(
            F.lit("id"), F.col("o_orderkey").cast("string"),
            F.lit("user_id"), F.col("o_custkey").cast("string"),
            F.lit("order_status"), F.col("o_orderstatus"),
            F.lit("total_amount"), F.col("o_totalprice").cast("string"))).alias("rows"),
        F.col("o_orderkey").alias("seq"),
    )
    markers = o.select(
        F.lit("TRANSACTIONBEGIN").alias("entry_type"), F.lit(None).cast("string").alias("table"),
        F.lit(None).cast("string").alias("op"),
        F.array().cast("array<map<string,string>>").alias("rows"),
        F.col("o_orderkey").alias("seq"),
    )
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    lines = li.select(
        F.lit("ROWDATA").alias("entry_type"), F.lit("order_detail").alias("table"),
        _op(F.col("l_orderkey") + F.col("l_linenumber")).alias("op"),
        F.array(F.create_map(
            F.lit("id"), F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            F.lit("order_id"), F.col("l_orderkey").cast("string"),
            F.lit("sku_id"), F.col("l_partkey").cast("string"))).alias("rows"),
        F.col("l_orderkey").alias("seq"),
    )
    users = user_change_entries(spark, sf_dir)
    return orders.unionByName(markers).unionByName(lines).unionByName(users)
