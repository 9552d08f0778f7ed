"""Bounded alert state, late events, live totals, pending lines, bucketed look-ups and generated ids."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from livemart.operators import alerts, dau
from livemart.operators.dashboard import metric_cards
from livemart.schemas import STARTUP_LOG
from livemart.sources import adapters as A
from livemart.streaming import jobs, totals
from livemart.streaming.replay import replay_stream
from livemart.streaming.sources import POSITION, read_folder
from livemart.streaming.upsert import KeyedTable

ONCE = {"availableNow": True}
EVENT = "event_id long, mid string, uid string, evid string, itemid string, ts_ms long"
ALERT = ("id string, mid string, uids array<string>, itemIds array<string>, events array<string>, ts long, "
         "window_start string, window_end string, ok boolean")
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def run_alerts(spark, root, watermark="10 seconds", window=30_000, slide=5_000):
    events = spark.createDataFrame([], EVENT)
    table = KeyedTable(f"{root}/alerts", ["mid", "ts"], keep="ok", schema=ALERT)

    def archive(s):
        return s.read.schema(events.schema).parquet(f"{root}/ev")
    q = jobs.closed_alert_query(read_folder(spark, f"{root}/ev", events.schema), archive, table, f"{root}/ck", window, slide,
                                watermark=watermark, trigger=ONCE)
    q.awaitTermination()
    return table, archive, q


def key(row):
    return (row.mid, row.ts, tuple(row.uids), tuple(row.itemIds), tuple(row.events))


def test_closed_windows_equal_the_batch_form_with_bounded_state(spark, scratch):
    rng = random.Random(3)
    n = itertools.count()
    rows = [(next(n), rng.choice(["hot", "hot", "d1", "d2", None]), rng.choice(["u1", "u2", "u3", "", "u4", None]),
             rng.choice(["coupon"] * 6 + ["addCart", "clickItem"]), str(k % 9), T0 + k * 700) for k in range(1500)]
    for k in range(0, 1500, 150):
        put(spark, rows[k:k + 150], EVENT, f"{scratch}/ev")
    put(spark, [(None, None, None, None, None, T0 + 10_000_000)], EVENT, f"{scratch}/ev")  # heartbeat
    table, archive, q = run_alerts(spark, scratch)
    want = {key(r) for r in alerts.coupon_alerts(spark.createDataFrame(rows, EVENT), 30_000, 5_000).collect()}
    assert {key(r) for r in table.view(spark).collect()} == want and len(want) > 20
    # a slice spans 105 s: panes and windows that can be open at once, for four devices, whatever the events
    most = max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress)
    assert most <= 4 * 2 * ((105 + 30 + 10) // 5 + 2)


def test_stateful_plan_has_no_event_columns(spark):
    ev = spark.createDataFrame([], EVENT).withColumn("event_time", F.timestamp_millis("ts_ms"))
    plan = alerts.alerting_windows(ev, 30_000, 5_000)._jdf.queryExecution().optimizedPlan().toString()
    sums = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(sums) == 2 and not any(c in line for line in sums for c in ("event_id", "itemid", "collect"))


@pytest.mark.parametrize("min_users", [1, 2, 3, 16, 17, 40])
def test_sketch_decides_exactly_and_stays_small(spark, min_users):
    rows = []
    for users in (min_users - 1, min_users, min_users + 1, 500):
        rows += [(k, f"d{users}", "" if k == 0 else f"u{k}", "coupon", "1", T0 + 7 * k) for k in range(users)] * 2
    ev = spark.createDataFrame(rows, EVENT).withColumn("event_time", F.timestamp_millis("ts_ms"))
    got = {(r.mid, r.wstart) for r in alerts.alerting_windows(ev, 30_000, 5_000, min_users).collect()}
    want = {(r.mid, r.ts - 30_000) for r in alerts.coupon_alerts(ev, 30_000, 5_000, min_users).collect()}
    assert got == want
    size = alerts.sketch_size(min_users)
    longest = ev.groupBy("mid").agg(F.length(F.theta_sketch_agg("uid", size)).alias("n")).agg(F.max("n")).first()[0]
    assert longest <= 8 * (2 << size) + 64


def test_late_events_are_decided_again(spark, scratch):
    def coupon(i, mid, uid, at):
        return (i, mid, uid, "coupon", str(i), T0 + at)
    put(spark, [coupon(1, "a", "u1", 1000), coupon(2, "a", "u2", 2000), coupon(3, "a", "u3", 3000),
                coupon(4, "b", "u1", 1000), coupon(5, "b", "u2", 2000)], EVENT, f"{scratch}/ev")
    put(spark, [coupon(6, "c", "u1", 400_000)], EVENT, f"{scratch}/ev")
    put(spark, [coupon(7, "c", "u1", 800_000)], EVENT, f"{scratch}/ev")
    # behind the watermark: a click that cancels a's alerts, and b's third user
    put(spark, [(8, "a", "u9", "clickItem", "1", T0 + 4000), coupon(9, "b", "u3", 3000)], EVENT, f"{scratch}/ev")
    put(spark, [(10, None, None, None, None, T0 + 9_000_000)], EVENT, f"{scratch}/ev")
    table, archive, _ = run_alerts(spark, scratch)
    assert {r.mid for r in table.view(spark).collect()} == {"a"}
    schema = spark.createDataFrame([], EVENT).schema
    late = KeyedTable(f"{scratch}/late", ["event_id"], schema=schema)
    clock = KeyedTable(f"{scratch}/clock", ["batch"], schema="batch long, ts_ms long")
    jobs.late_events_query(read_folder(spark, f"{scratch}/ev", schema), late, clock, f"{scratch}/cl", 10_000,
                           trigger=ONCE).awaitTermination()
    assert {8, 9} <= {r.event_id for r in late.view(spark).collect()}
    want = {key(r) for r in alerts.coupon_alerts(archive(spark), 30_000, 5_000).collect()}
    assert want and {w[0] for w in want} == {"b"}
    for _ in range(2):  # again: the same, as another repair
        jobs.repair_alerts(spark, table, archive, late, 30_000, 5_000)
        assert {key(r) for r in table.view(spark).collect()} == want
    assert table.next_repair(spark) == 3


def test_no_late_event_changes_nothing(spark, scratch):
    put(spark, [(k, "a", f"u{k}", "coupon", "1", T0 + k) for k in range(3)], EVENT, f"{scratch}/ev")
    put(spark, [(10, None, None, None, None, T0 + 9_000_000)], EVENT, f"{scratch}/ev")
    table, archive, _ = run_alerts(spark, scratch)
    before = {key(r) for r in table.view(spark).collect()}
    late = KeyedTable(f"{scratch}/late", ["event_id"], schema=EVENT)
    jobs.repair_alerts(spark, table, archive, late, 30_000, 5_000)
    assert {key(r) for r in table.view(spark).collect()} == before and len(before) == 6


def test_repairs_of_two_jobs_keep_apart(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["k"])
    t.write(spark.createDataFrame([("a", 1)], "k string, v int"), 0)
    one = "k string, v int, batch_id long"
    assert t.next_repair(spark) == 1
    t.repair(spark.createDataFrame([("b", 2, 0)], one), 1, "lines")
    t.repair(spark.createDataFrame([("c", 3, 0)], one), 1, "users")  # the same number: another job's
    assert sorted((r.k, r.v) for r in t.view(spark).collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert t.next_repair(spark) == 2
    t.repair(spark.createDataFrame([("b", 5, 0)], one), 2, "users")
    assert sorted((r.k, r.v) for r in t.view(spark).collect()) == [("a", 1), ("b", 5), ("c", 3)]
    assert sorted((r.k, r.v) for r in t.view(spark, before_repair=2).collect()) == [("a", 1), ("b", 2), ("c", 3)]
    t.write(spark.createDataFrame([("b", 9)], "k string, v int"), 1)  # a later batch wins over a repair
    assert {r.k: r.v for r in t.view(spark).collect()}["b"] == 9


def test_table_without_rows_can_be_read(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["logdate", "mid"], partition_by=["logdate"], schema=STARTUP_LOG)
    assert t.view(spark).count() == 0 and t.next_batch(spark) == 0 and t.next_repair(spark) == 1
    empty = spark.createDataFrame([], STARTUP_LOG)
    t.write(empty, 0)
    assert t.view(spark).count() == 0
    other = KeyedTable(f"{scratch}/o", ["logdate", "mid"], partition_by=["logdate"])
    other.write(empty, 0)  # no schema stated: that of the write
    assert other.view(spark).columns and other.view(spark).count() == 0
    bucketed = KeyedTable(f"{scratch}/b", ["mid"], buckets=4, schema="mid string, first_day string")
    assert bucketed.view(spark, keys=spark.createDataFrame([("x",)], "mid string")).count() == 0


def scanned_folders(spark, df, column):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # the scan's filters in full
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return [line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in plan.splitlines()
            if "FileScan parquet" in line and column in line]


def test_look_up_of_one_user_reads_one_bucket(spark, scratch):
    t = KeyedTable(f"{scratch}/users", ["id"], order=["seq"], buckets=16)
    rows = [(str(k), f"n{k}", s) for k in range(200) for s in (1, 2)]
    t.write(spark.createDataFrame(rows[::2], "id string, name string, seq long"), 0)
    t.write(spark.createDataFrame(rows[1::2], "id string, name string, seq long"), 1)
    keys = spark.createDataFrame([("7",), ("7",)], "id string")
    one = t.view(spark, keys=keys)
    assert [tuple(r) for r in one.select("id", "name", "seq").collect()] == [("7", "n7", 2)]
    filters = scanned_folders(spark, one, "bucket")
    bucket = keys.select(F.pmod(F.xxhash64("id"), F.lit(16))).first()[0]
    assert filters and all(f"= {bucket})" in f for f in filters)
    read = t.raw(spark).where(F.col("bucket") == bucket).select(F.input_file_name()).distinct().count()
    assert read == 2  # one file a batch of 16 buckets
    t.compact(spark, 1)
    assert [tuple(r) for r in t.view(spark, keys=keys).select("id", "seq").collect()] == [("7", 2)]
    assert t.view(spark).count() == 200
    assert t.view(spark, keys=keys.limit(0)).count() == 0


def test_reads_before_a_batch(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["k"])
    for b in range(3):
        t.write(spark.createDataFrame([("a", b)], "k string, v int"), b)
    assert [t.view(spark, before_batch=b).collect()[0].v for b in (1, 2, 3)] == [0, 1, 2]
    assert t.view(spark, before_batch=0).count() == 0 and t.next_batch(spark) == 3


DOC = "id string, v string, at long"


def test_null_ids_by_position(spark, scratch):
    rows = [(None, "same", 1), (None, "same", 2), ("x", "a", 3), (None, "same", 4), ("x", "b", 900)]
    src = replay_stream(spark.createDataFrame(rows, DOC), f"{scratch}/in", "at", 2, 1, with_position=True)
    t = KeyedTable(f"{scratch}/t", ["id"], position=POSITION)
    for ck in ("a", "b"):  # the second reads all positions again: a redelivery
        jobs.document_query(src.drop("at"), t, f"{scratch}/{ck}", trigger=ONCE).awaitTermination()
        got = sorted((len(r.id), r.v) for r in t.view(spark).collect())
        assert got == [(1, "b"), (64, "same"), (64, "same"), (64, "same")]
        assert t.view(spark).columns == ["id", "v"]


def cards(df):
    return sorted((r.date, r.id, r.value) for r in df.collect() if r.value)


def test_totals_follow_changed_and_repeated_rows(spark, scratch):
    order = "id string, total_amount double, create_time string, seq long"
    batches = [[("1", 10.0, "2024-01-01 10:00:00", 1), ("2", 5.5, "2024-01-01 11:00:00", 1), ("3", None, "2024-01-02 00:00:00", 1)],
               [("1", 10.0, "2024-01-01 10:00:00", 1), ("2", 7.25, "2024-01-02 11:00:00", 2), ("2", 9.0, "2024-01-03 11:00:00", 3)],
               [("2", 7.25, "2024-01-02 11:00:00", 2), ("4", 1.0, "2024-01-01 10:30:00", 1)]]
    t = totals.totals_table(f"{scratch}/tot", compact_every=2)
    held = KeyedTable(f"{scratch}/orders", ["id"], order=["seq"], buckets=4,
                      schema=f"id string, create_date string, create_hour string, total_amount {totals.AMOUNT}, seq long")
    for k, rows in enumerate(batches):
        put(spark, rows, order, f"{scratch}/in")
        src = read_folder(spark, f"{scratch}/in", spark.createDataFrame([], order).schema)
        totals.order_totals_query(src, held, t, f"{scratch}/ck", trigger=ONCE).awaitTermination()
    hours = {(r.date, r.hour): r.value for r in totals.live_hours(spark, t, totals.ORDER_AMOUNT).collect()}
    # order 2 has moved to its last version's day, its older version changes nothing
    assert hours == {("2024-01-01", "10"): 11.0, ("2024-01-02", "00"): 0.0, ("2024-01-03", "11"): 9.0}


def test_device_totals_equal_a_recount_with_late_starts(spark, scratch):
    logs = A.startup_logs(spark, SF_SMALL)
    late = F.when(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0, 5 * 86_400_000).otherwise(0)
    src = replay_stream(logs.withColumn("arrival", F.col("ts_ms") + late), f"{scratch}/in", "arrival", 3).drop("arrival")
    table = KeyedTable(f"{scratch}/dau", ["logdate", "mid"], partition_by=["logdate"], schema=STARTUP_LOG)
    devices = KeyedTable(f"{scratch}/dev", ["mid"], buckets=4, schema="mid string, first_day string")
    t = totals.totals_table(f"{scratch}/tot")
    totals.dau_totals_query(src, table, devices, t, f"{scratch}/ck", trigger=ONCE).awaitTermination()
    none = totals.totals_table(f"{scratch}/none")
    keys = dau.device_days(logs)
    want = metric_cards(dau.dau_total(keys), dau.new_devices(keys),
                        spark.createDataFrame([], "create_date string, sum_amount double"))
    assert cards(totals.live_cards(spark, t, none)) == cards(want)
    hours = {(r.date, r.hour): r.value for r in totals.live_hours(spark, t, totals.DAU).collect()}
    assert hours == {(r.logdate, r.loghour): r.ct for r in dau.dau_hour_of_logs(logs).collect()}


def test_totals_of_a_replayed_batch(spark, scratch):
    t = totals.totals_table(f"{scratch}/tot")

    def deltas(n):
        return spark.createDataFrame([("m", "d", "h", n)], "metric string, date string, hour string, rows long") \
            .withColumn("amount", F.lit(n).cast(totals.AMOUNT))
    for batch, n in ((0, 3), (1, 4), (1, 4), (2, -5)):
        totals.add(t, deltas(n), batch)
    assert [tuple(r)[3:] for r in t.view(spark).select("metric", "date", "hour", "rows", "amount").collect()] == [(2, 2)]


ORDER = "id string, order_status string, user_id string, total_amount double, create_time string"
LINE = "id string, order_id string, sku_name string, sku_id string, order_price string, img_url string, sku_num string"


def test_lines_wait_for_their_orders(spark, scratch):
    from livemart.plans.streams import CrashingTable, _run_through_crash, pending_tables

    def order(i):
        return (i, "O", "7", 9.0, "2023-11-14 22:13:20")

    def line(i, o):
        return (i, o, "red widget", "s1", "2.5", None, "1")
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"], buckets=4)
    users.write(spark.createDataFrame([("7", "u", "L1", "1990-01-01", "F", 1)],
                                      "id string, login_name string, user_level string, birthday string, gender string, seq long"), 0)
    batches = [([], [line("1_1", "1"), line("9_1", "9"), line("0_1", None)]), ([order("2")], [line("2_1", "2")]),
               ([order("1")], []), ([order("1")], [line("1_2", "1"), line("1_1", "1")]), ([], [line("2_2", "2")])]
    for o, d in batches:
        put(spark, o, ORDER, f"{scratch}/o")
        put(spark, d, LINE, f"{scratch}/d")
    stored, pending = pending_tables(scratch)
    table = CrashingTable(f"{scratch}/sales", ["order_detail_id"])
    table.crash_at = 2  # the batch that claims: run again, it claims the same line

    def start():
        o = read_folder(spark, f"{scratch}/o", spark.createDataFrame([], ORDER).schema)
        d = read_folder(spark, f"{scratch}/d", spark.createDataFrame([], LINE).schema)
        return jobs.pending_sale_query(o, d, stored, pending, users, table, f"{scratch}/ck", "2001-08-02", trigger=ONCE)
    _run_through_crash(start)
    assert sorted((r.order_detail_id, r.user_gender) for r in table.view(spark).collect()) == [
        ("1_1", "F"), ("1_2", "F"), ("2_1", "F"), ("2_2", "F")]
    assert sorted(r.id for r in pending.view(spark).collect()) == ["0_1", "9_1"]
    written = table.raw(spark).groupBy("order_detail_id").count().where("order_detail_id = '2_1'").first()
    assert written["count"] == 1


def test_seen_set_survives_a_lost_checkpoint(spark, scratch):
    logs = A.startup_logs(spark, SF_SMALL)
    table = KeyedTable(f"{scratch}/dau", ["logdate", "mid"], partition_by=["logdate"], schema=STARTUP_LOG)
    shuffled = logs.withColumn("arrival", F.pmod(F.xxhash64("event_id"), F.lit(1000)))  # earlier starts come later too
    src = replay_stream(shuffled, f"{scratch}/in", "arrival", 3).drop("arrival")
    for ck in ("a", "b"):
        jobs.seen_query(src, table, f"{scratch}/{ck}", trigger=ONCE).awaitTermination()
        view = table.view(spark)
        want = dau.daily_active(logs).select(*view.columns)
        assert view.exceptAll(want).isEmpty() and want.exceptAll(view).isEmpty()
    rows = table.raw(spark).count()
    jobs.seen_query(src, table, f"{scratch}/b", trigger=ONCE).awaitTermination()  # nothing new
    assert table.raw(spark).count() == rows
    assert jobs.first_batch(spark, f"{scratch}/b", table) == 3
