"""Streaming forms: late data on both join sides, restarts, idempotent upserts."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from livemart.operators import dau
from livemart.sources import adapters as A
from livemart.streaming import jobs
from livemart.streaming.replay import replay_stream, to_chunks
from livemart.streaming.sources import read_folder
from livemart.streaming.upsert import KeyedTable

ONCE = {"availableNow": True}

ORDER_SCHEMA = "id string, order_status string, user_id string, total_amount double, create_time string, order_ms long"
LINE_SCHEMA = ("id string, order_id string, sku_name string, sku_id string, order_price string, "
               "img_url string, sku_num string, change_ms long")


def _write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_late_order_pairs_every_line(spark, scratch):
    base = 1_700_000_000_000
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"])
    users.write(spark.createDataFrame([("7", "u", "L1", "1990-01-01", "F", 1)],
                                      "id string, login_name string, user_level string, birthday string, gender string, seq long"), 0)
    # batch 1: a line whose order has not arrived; batch 2: the order and another line
    _write(spark, [], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("1_1", "1", "red widget", "s1", "2.5", None, "1", base - 1000)], LINE_SCHEMA, f"{scratch}/d")
    _write(spark, [("1", "O", "7", 9.0, "2023-11-14 22:13:20", base)], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("1_2", "1", "blue bolt", "s2", "1.0", None, "1", base + 1000),
                   ("9_1", "9", "lonely", "s3", "1.0", None, "1", base)], LINE_SCHEMA, f"{scratch}/d")
    o = read_folder(spark, f"{scratch}/o", spark.createDataFrame([], ORDER_SCHEMA).schema)
    d = read_folder(spark, f"{scratch}/d", spark.createDataFrame([], LINE_SCHEMA).schema)
    table = KeyedTable(f"{scratch}/sales", ["order_detail_id"])
    jobs.sale_query(o, d, users, table, f"{scratch}/ckpt", "2001-08-02", trigger=ONCE).awaitTermination()
    got = {r.order_detail_id: (r.order_id, r.user_gender, r.user_level) for r in table.view(spark).collect()}
    assert got == {"1_1": ("1", "F", "L1"), "1_2": ("1", "F", "L1")}


def test_keyed_table_is_idempotent_and_later_batches_win(spark, scratch):
    t = KeyedTable(f"{scratch}/kt", ["k"])
    df1 = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    t.write(df1, 0)
    t.write(df1, 0)  # replayed batch
    t.write(spark.createDataFrame([("a", 2)], "k string, v int"), 1)
    assert sorted((r.k, r.v) for r in t.view(spark).collect()) == [("a", 2), ("b", 1)]
    t.compact(spark, 1)
    t.write(spark.createDataFrame([("b", 3)], "k string, v int"), 2)
    assert sorted((r.k, r.v) for r in t.view(spark).collect()) == [("a", 2), ("b", 3)]
    # folded batches are pruned: the raw read holds the base (2 keys) + batch 2
    assert t.raw(spark).count() == 3
    t.compact(spark, 2)
    assert t.raw(spark).count() == 2
    assert sorted((r.k, r.v) for r in t.view(spark).collect()) == [("a", 2), ("b", 3)]


def test_dau_stream_restart_and_equals_batch(spark, scratch):
    st = A.startup_logs(spark, SF_SMALL)
    src_path = f"{scratch}/in"
    first = st.where(F.col("logdate") < "2024-01-15")
    rest = st.where(F.col("logdate") >= "2024-01-15")
    table = KeyedTable(f"{scratch}/dau", ["logdate", "mid"])
    ck = f"{scratch}/ckpt"
    jobs.dau_query(replay_stream(first, src_path, "ts_ms", 2), table, ck, trigger=ONCE).awaitTermination()
    n_first = table.view(spark).count()
    # restart on the same checkpoint with new files: only the new input is processed
    jobs.dau_query(replay_stream(rest, src_path, "ts_ms", 2), table, ck, trigger=ONCE).awaitTermination()
    view = table.view(spark)
    batch = dau.daily_active(st)
    assert n_first > 0
    assert view.count() == batch.count()
    assert view.exceptAll(batch.select(*view.columns)).count() == 0


def test_alert_stream_drops_cancelled_alert(spark, scratch):
    schema = "event_id long, mid string, uid string, evid string, itemid string, ts_ms long"
    t0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC
    _write(spark, [(1, "d", "u1", "coupon", "1", t0 + 60_000), (2, "d", "u2", "coupon", "2", t0 + 120_000),
                   (3, "d", "u3", "coupon", "3", t0 + 180_000)], schema, f"{scratch}/ev")
    table = KeyedTable(f"{scratch}/alerts", ["mid", "ts"], keep="ok")
    src = read_folder(spark, f"{scratch}/ev", spark.createDataFrame([], schema).schema)
    ck = f"{scratch}/ckpt"
    jobs.alert_query(src, table, ck, "10 minutes", "5 minutes", watermark="1 hour", trigger=ONCE).awaitTermination()
    assert table.view(spark).count() == 2  # windows [-5m,5m) and [0m,10m)
    _write(spark, [(4, "d", "u4", "clickItem", "4", t0 + 240_000)], schema, f"{scratch}/ev")
    src = read_folder(spark, f"{scratch}/ev", spark.createDataFrame([], schema).schema)
    jobs.alert_query(src, table, ck, "10 minutes", "5 minutes", watermark="1 hour", trigger=ONCE).awaitTermination()
    assert table.view(spark).count() == 0


def test_refresh_fills_user_that_arrived_late(spark, scratch):
    sales_t = KeyedTable(f"{scratch}/sales", ["order_detail_id"])
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"])
    row = ("1_1", "1", "O", "2024-01-01 10:00:00", "7", "s1", None, 0, None, 2.5, "red widget", "2024-01-01", "1")
    schema = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
              "sku_id string, user_gender string, user_age int, user_level string, sku_price double, "
              "sku_name string, dt string, sku_num string")
    sales_t.write(spark.createDataFrame([row], schema), 0)
    users.write(spark.createDataFrame([("7", "u", "L1", "2000-08-02", "F", 1)],
                                      "id string, login_name string, user_level string, birthday string, gender string, seq long"), 0)
    for _ in range(2):  # run again after a lost driver: the same rows
        jobs.refresh_missing_users(spark, sales_t, users, "2001-08-02", 1)
    r = sales_t.view(spark).first()
    assert (r.user_gender, r.user_level, r.user_age) == ("F", "L1", 1)


def test_order_and_log_archive_sinks_and_metrics(spark, scratch):
    from livemart.streaming.metrics import attach
    log = attach(spark)
    rows = A.order_rows(spark, SF_SMALL, with_customer=True)
    to_chunks(rows.withColumn("ms", F.col("id").cast("long")), f"{scratch}/o", "ms", 2)
    src = read_folder(spark, f"{scratch}/o", rows.withColumn("ms", F.lit(0).cast("long")).schema).drop("ms")
    orders_t = KeyedTable(f"{scratch}/orders", ["create_date", "id"], partition_by=["create_date"])
    jobs.order_query(src, orders_t, f"{scratch}/ck1", splits=2, trigger=ONCE).awaitTermination()
    stored = orders_t.view(spark)
    assert stored.count() == rows.count()
    assert stored.where(~F.col("consignee_tel").startswith("*******")).count() == 0
    raw = A.raw_log_json(spark, SF_SMALL).select("value")
    raw.write.text(f"{scratch}/raw")
    from livemart.streaming.sources import read_log_text
    jobs.log_route_query(read_log_text(spark, f"{scratch}/raw"), f"{scratch}/logs", f"{scratch}/ck2",
                         stamp=1_704_067_200_000, trigger=ONCE).awaitTermination()
    arch = spark.read.parquet(f"{scratch}/logs")
    assert arch.count() == raw.count()
    assert {r.topic for r in arch.select("topic").distinct().collect()} == {"STARTUP", "EVENT"}
    assert {str(r.logdate) for r in arch.select("logdate").distinct().collect()} == {"2024-01-01"}
    import time
    time.sleep(1)
    spark.streams.removeListener(log)
    assert any(b.get("input_rows") for b in log.batches)


def test_null_key_gets_stable_generated_key(spark, scratch):
    t = KeyedTable(f"{scratch}/docs", ["id"])
    df = spark.createDataFrame([(None, "a"), ("k1", "b")], "id string, v string")
    t.write(df, 0)
    t.write(df, 0)
    rows = sorted((r.id, r.v) for r in t.view(spark).collect())
    assert len(rows) == 2 and rows[1] == ("k1", "b") and len(rows[0][0]) == 64


def test_dead_letters_stream(spark, scratch):
    base = 1_700_000_000_000
    _write(spark, [("1", "O", "7", 9.0, "x", base), ("2", "O", "7", 9.0, "x", base)], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("1_1", "1", "n", "s", "1", None, "1", base + 500),
                   ("9_1", "9", "n", "s", "1", None, "1", base)], LINE_SCHEMA, f"{scratch}/d")
    # later traffic moves the watermark past the first rows
    _write(spark, [("3", "O", "7", 9.0, "x", base + 3_600_000)], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("3_1", "3", "n", "s", "1", None, "1", base + 3_600_000)], LINE_SCHEMA, f"{scratch}/d")
    o = read_folder(spark, f"{scratch}/o", spark.createDataFrame([], ORDER_SCHEMA).schema)
    d = read_folder(spark, f"{scratch}/d", spark.createDataFrame([], LINE_SCHEMA).schema)
    jobs.sale_dead_letters_query(o, d, f"{scratch}/dead", f"{scratch}/ck", max_delay="10 seconds",
                                 watermark="1 minute", trigger=ONCE).awaitTermination()
    got = sorted((r.side, r.id) for r in spark.read.parquet(f"{scratch}/dead").collect())
    assert got == [("order", "2"), ("order_detail", "9_1")]


def test_kafka_option_builders():
    from livemart.streaming.sources import kafka_options, write_topic_options
    o = kafka_options("h1:9092,h2:9092", "STARTUP", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "STARTUP" and o["startingOffsets"] == "latest"
    assert o["kafka.bootstrap.servers"] == "h1:9092,h2:9092" and o["maxOffsetsPerTrigger"] == "1000"
    assert "enable.auto.commit" not in o  # offsets live in the checkpoint
    assert write_topic_options("h:1") == {"kafka.bootstrap.servers": "h:1"}


def test_keyed_table_day_partitions_prune_under_the_merge(spark, scratch):
    t = KeyedTable(f"{scratch}/dau", ["logdate", "mid"], partition_by=["logdate"])
    t.write(spark.createDataFrame([("2024-01-01", "m1", 1), ("2024-01-02", "m1", 2)],
                                  "logdate string, mid string, v int"), 0)
    t.write(spark.createDataFrame([("2024-01-02", "m1", 3)], "logdate string, mid string, v int"), 1)
    t.compact(spark, 0)
    day = t.view(spark).where(F.col("logdate") == "2024-01-02")
    assert [(r.logdate, r.v) for r in day.collect()] == [("2024-01-02", 3)]
    plan = day._jdf.queryExecution().executedPlan().toString()
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
    # every scan (base and newer batches) prunes day folders
    assert scans and all("logdate" in l.split("PartitionFilters")[1].split("PushedFilters")[0] for l in scans)


def test_read_keyed_view_for_one_day(spark, scratch):
    from livemart.operators import dau as D
    from livemart.sources.tables import read_keyed_view
    t = KeyedTable(f"{scratch}/dau", ["logdate", "mid"], partition_by=["logdate"])
    rows = D.daily_active(A.startup_logs(spark, SF_SMALL))
    t.write(rows, 0)
    view = read_keyed_view(spark, f"{scratch}/dau", ["logdate", "mid"], partition_by=["logdate"])
    got = {r.loghour: r.ct for r in D.dau_hour(view, "2024-01-05").collect()}
    want = {r.loghour: r.ct for r in D.dau_hour(rows, "2024-01-05").collect()}
    assert got == want and got


def test_periodic_compaction_inside_foreach_batch(spark, scratch):
    t = KeyedTable(f"{scratch}/kt", ["k"])
    fn = t.foreach_batch(compact_every=2)
    for b in range(5):
        fn(spark.createDataFrame([("a", b), (f"x{b}", b)], "k string, v int"), b)
    assert t._base_id(spark) == 4
    assert t.raw(spark).count() == 6  # base only: a + x0..x4
    got = sorted((r.k, r.v) for r in t.view(spark).collect())
    assert got == [("a", 4), ("x0", 0), ("x1", 1), ("x2", 2), ("x3", 3), ("x4", 4)]


def test_dau_stream_reports_counts_before_and_after_dedupe(spark, scratch):
    from livemart.streaming.metrics import batch_summary
    st = A.startup_logs(spark, SF_SMALL)
    table = KeyedTable(f"{scratch}/dau", ["logdate", "mid"])
    q = jobs.dau_query(replay_stream(st, f"{scratch}/in", "ts_ms", 2), table, f"{scratch}/ck", trigger=ONCE)
    q.awaitTermination()
    summaries = [batch_summary(p) for p in q.recentProgress]
    seen_in = sum(s["observed"].get("startups", {}).get("rows", 0) for s in summaries)
    seen_out = sum(s["observed"].get("dau_rows", {}).get("rows", 0) for s in summaries)
    assert seen_in == st.count() and 0 < seen_out <= seen_in


def test_user_arriving_after_its_sale_is_filled_by_refresh(spark, scratch):
    base = 1_700_000_000_000
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"])
    user_schema = "id string, login_name string, user_level string, birthday string, gender string, seq long"
    users.write(spark.createDataFrame([("8", "other", "L0", "1990-01-01", "M", 1)], user_schema), 0)
    _write(spark, [("1", "O", "7", 9.0, "2023-11-14 22:13:20", base)], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("1_1", "1", "red widget", "s1", "2.5", None, "1", base)], LINE_SCHEMA, f"{scratch}/d")
    o = read_folder(spark, f"{scratch}/o", spark.createDataFrame([], ORDER_SCHEMA).schema)
    d = read_folder(spark, f"{scratch}/d", spark.createDataFrame([], LINE_SCHEMA).schema)
    sales_t = KeyedTable(f"{scratch}/sales", ["order_detail_id"])
    q = jobs.sale_query(o, d, users, sales_t, f"{scratch}/ck", "2001-08-02", trigger=ONCE)
    q.awaitTermination()
    r = sales_t.view(spark).first()
    assert (r.user_gender, r.user_level, r.user_age) == (None, None, 0)  # user 7 not there yet
    users.write(spark.createDataFrame([("7", "u", "L1", "2000-08-02", "F", 1)], user_schema), 1)
    for _ in range(2):  # run again after a lost driver: the same rows
        jobs.refresh_missing_users(spark, sales_t, users, "2001-08-02", 1)
    r = sales_t.view(spark).first()
    assert (r.user_gender, r.user_level, r.user_age) == ("F", "L1", 1)
    assert sales_t.view(spark).count() == 1
    # the next micro-batch neither undoes the repair nor is hidden by it, nor does folding
    _write(spark, [("2", "O", "8", 9.0, "2023-11-14 22:13:20", base)], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("2_1", "2", "blue bolt", "s1", "2.5", None, "1", base)], LINE_SCHEMA, f"{scratch}/d")
    q = jobs.sale_query(o, d, users, sales_t, f"{scratch}/ck", "2001-08-02", trigger=ONCE)
    q.awaitTermination()
    want = {"1_1": "F", "2_1": "M"}
    assert {r.order_detail_id: r.user_gender for r in sales_t.view(spark).collect()} == want
    sales_t.compact(spark, q.lastProgress["batchId"])
    assert {r.order_detail_id: r.user_gender for r in sales_t.view(spark).collect()} == want


EVENT_SCHEMA = "event_id long, mid string, uid string, evid string, itemid string, ts_ms long"


def test_alert_survives_a_cancelled_window_of_its_minute(spark, scratch):
    from livemart.operators import alerts
    t0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC
    rows = [(1, "d", "u1", "coupon", "1", t0 + 1000), (2, "d", "u2", "coupon", "2", t0 + 2000),
            (3, "d", "u3", "coupon", "3", t0 + 3000), (4, "d", "u4", "clickItem", "4", t0 + 34_000)]
    _write(spark, rows, EVENT_SCHEMA, f"{scratch}/ev")
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    table = KeyedTable(f"{scratch}/alerts", ["mid", "ts"], keep="ok")
    src = read_folder(spark, f"{scratch}/ev", events.schema)
    jobs.alert_query(src, table, f"{scratch}/ck", "30 seconds", "5 seconds", trigger=ONCE).awaitTermination()
    batch = alerts.coupon_alerts(events, 30_000, 5_000)
    windows = {(r.id, r.ts) for r in batch.collect()}
    assert {(r.id, r.ts) for r in table.view(spark).collect()} == windows
    minute = {(r.id, r.ts) for r in alerts.per_minute(table.view(spark)).collect()}
    assert minute == {(r.id, r.ts) for r in alerts.per_minute(batch).collect()}
    assert 0 < len(minute) < len(windows) and ("d_28401120", t0 + 30_000) in minute


def test_redelivered_order_counts_once(spark, scratch):
    from livemart.operators import orders as O
    row = A.order_rows(spark, SF_SMALL, with_customer=True).where("id = '1'")
    schema = row.schema
    table = KeyedTable(f"{scratch}/orders", ["create_date", "id"], partition_by=["create_date"])
    for _ in range(2):
        row.write.mode("append").parquet(f"{scratch}/in")
        jobs.order_query(read_folder(spark, f"{scratch}/in", schema), table, f"{scratch}/ck",
                         trigger=ONCE).awaitTermination()
    once = O.amount_hour(O.order_info(row)).collect()
    assert len(once) == 1 and O.amount_hour(table.view(spark)).collect() == once


def test_line_outside_the_time_bound_is_paired_by_the_repair(spark, scratch):
    base = 1_700_000_000_000
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"])
    users.write(spark.createDataFrame([("7", "u", "L1", "1990-01-01", "F", 1)],
                                      "id string, login_name string, user_level string, birthday string, gender string, seq long"), 0)
    _write(spark, [("1", "O", "7", 9.0, "2023-11-14 22:13:20", base)], ORDER_SCHEMA, f"{scratch}/o")
    _write(spark, [("1_1", "1", "red widget", "s1", "2.5", None, "1", base),
                   ("1_2", "1", "blue bolt", "s2", "1.0", None, "1", base + 30_000),
                   ("9_1", "9", "lonely", "s3", "1.0", None, "1", base)], LINE_SCHEMA, f"{scratch}/d")
    o = read_folder(spark, f"{scratch}/o", spark.createDataFrame([], ORDER_SCHEMA).schema)
    d = read_folder(spark, f"{scratch}/d", spark.createDataFrame([], LINE_SCHEMA).schema)
    table = KeyedTable(f"{scratch}/sales", ["order_detail_id"])
    stored_o, stored_d = KeyedTable(f"{scratch}/so", ["id"]), KeyedTable(f"{scratch}/sd", ["id"])
    jobs.sale_query(o, d, users, table, f"{scratch}/ck", "2001-08-02", trigger=ONCE).awaitTermination()
    assert [r.order_detail_id for r in table.view(spark).collect()] == ["1_1"]
    jobs.order_query(o, stored_o, f"{scratch}/cko", trigger=ONCE).awaitTermination()
    jobs.line_query(d, stored_d, f"{scratch}/ckd", trigger=ONCE).awaitTermination()
    for repair in (1, 1, 2):  # a repair run again, and a later one, add nothing
        jobs.pair_late(spark, table, stored_o, stored_d, users, "2001-08-02", repair)
        got = sorted((r.order_detail_id, r.user_gender) for r in table.view(spark).collect())
        assert got == [("1_1", "F"), ("1_2", "F")]


def test_late_start_ups_are_repaired_and_an_empty_repair_changes_nothing(spark, scratch):
    logs = A.startup_logs(spark, SF_SMALL)
    first = dau.daily_active(logs)
    key = ("logdate", "mid")
    full = KeyedTable(f"{scratch}/full", key, partition_by=["logdate"])
    full.write(first, 0)
    jobs.repair_dau(spark, full, logs, 1)  # nothing to repair: no file is written
    assert full.view(spark).count() == first.count()
    # a table that saw only the later half of every day
    half = KeyedTable(f"{scratch}/half", key, partition_by=["logdate"])
    half.write(dau.daily_active(logs.where(F.col("loghour") >= "12")), 0)
    for _ in range(2):  # a repair run again gives the same rows
        jobs.repair_dau(spark, half, logs, 1)
        got = half.view(spark).select(*first.columns)
        assert got.exceptAll(first).isEmpty() and first.exceptAll(got).isEmpty()


def test_replay_of_an_empty_table(spark, scratch):
    df = spark.createDataFrame([], "id long, ms long")
    src = replay_stream(df, f"{scratch}/in", "ms")
    q = (src.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/c")
            .trigger(availableNow=True).start(f"{scratch}/out"))
    q.awaitTermination()
    assert spark.read.schema(df.schema).parquet(f"{scratch}/out").count() == 0
