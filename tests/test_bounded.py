"""The sale and dead-letter jobs: what is kept between batches, late rows, copies, replays."""

from pyspark.sql import functions as F

from livemart.operators.keyed import once_per_key
from livemart.streaming import jobs
from livemart.streaming.sources import read_folder
from livemart.streaming.upsert import KeyedTable

ONCE = {"availableNow": True}
ORDER = "id string, order_status string, user_id string, total_amount double, create_time string, order_ms long"
LINE = ("id string, order_id string, sku_name string, sku_id string, order_price string, img_url string, sku_num string, "
        "change_ms long")
USER = "id string, login_name string, user_level string, birthday string, gender string, seq long"
T0, HOUR = 1_700_000_000_000, 3_600_000


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def order(i, at):
    return (str(i), "O", "7", 9.0, "2023-11-14 22:13:20", at)


def line(i, o, at, name="red widget"):
    return (str(i), str(o), name, "s1", "2.5", None, "1", at)


def streams(spark, root):
    return (read_folder(spark, f"{root}/o", spark.createDataFrame([], ORDER).schema),
            read_folder(spark, f"{root}/d", spark.createDataFrame([], LINE).schema))


def run_sales(spark, root):
    users = KeyedTable(f"{root}/users", ["id"], order=["seq"], buckets=4)
    users.write(spark.createDataFrame([("7", "u", "L1", "1990-01-01", "F", 1)], USER), 0)
    table = KeyedTable(f"{root}/sales", ["order_detail_id"])
    q = jobs.sale_query(*streams(spark, root), users, table, f"{root}/ck", "2001-08-02", trigger=ONCE)
    q.awaitTermination()
    return table, q


def kept(spark, root):
    return [spark.read.parquet(f"{root}/ck/open_rows/{n}").where("o is not null or d is not null").count() for n in (0, 1)]


def test_sale_job_keeps_only_rows_that_may_still_pair(spark, scratch):
    for k in range(3):  # three slices of a hundred hours
        at = T0 + k * 100 * HOUR
        put(spark, [order(f"{k}{n:02d}", at + n * HOUR) for n in range(100)], ORDER, f"{scratch}/o")
        put(spark, [line(f"{k}{n:02d}_1", f"{k}{n:02d}", at + n * HOUR + 1000) for n in range(100)], LINE, f"{scratch}/d")
    table, q = run_sales(spark, scratch)
    assert table.view(spark).count() == 300 and table.raw(spark).count() == 300
    assert max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress) == 0
    assert max(kept(spark, scratch)) <= 4


def test_sale_job_pairs_across_batches_once_and_drops_late_rows_and_copies(spark, scratch):
    slices = [([order(1, T0)], [line("2_1", 2, T0), line("1_1", 1, T0), line("1_1", 1, T0 + 500, "copy")]),
              ([order(2, T0 + 5000)], [line("1_1", 1, T0 + 2000, "copy"), line("1_2", 1, T0 + 9000)]),
              ([order(3, T0 + HOUR)], [line("3_1", 3, T0 + HOUR)]),
              # behind the watermark, though both sides come together
              ([order(4, T0)], [line("4_1", 4, T0), line("3_2", 3, T0 + HOUR + 9000), line("3_3", 3, T0 + HOUR + 11_000)])]
    for o, d in slices:
        put(spark, o, ORDER, f"{scratch}/o")
        put(spark, d, LINE, f"{scratch}/d")
    table, _ = run_sales(spark, scratch)
    got = sorted((r.order_detail_id, r.sku_name, r.batch_id) for r in table.raw(spark).collect())
    assert got == [("1_1", "red widget", 0), ("1_2", "red widget", 1), ("2_1", "red widget", 1),
                   ("3_1", "red widget", 2), ("3_2", "red widget", 3)]


def test_dead_letters_keep_only_open_rows_and_emit_once(spark, scratch):
    for k in range(3):
        at = T0 + k * 100 * HOUR
        put(spark, [order(f"{k}{n:02d}", at + n * HOUR) for n in range(100)], ORDER, f"{scratch}/o")
        put(spark, [line(f"{k}{n:02d}_1", f"{k}{n + (n % 10 == 0):02d}", at + n * HOUR) for n in range(100)], LINE, f"{scratch}/d")
    # the last order and line of a batch find partners in the next one
    put(spark, [order("x", T0 + 1000 * HOUR), order("y", T0 + 1000 * HOUR)], ORDER, f"{scratch}/o")
    put(spark, [line("z_1", "z", T0 + 1000 * HOUR), line("x_1", "x", T0 + 1000 * HOUR)], LINE, f"{scratch}/d")
    put(spark, [order("z", T0 + 1000 * HOUR + 9000)], ORDER, f"{scratch}/o")
    put(spark, [line("y_1", "y", T0 + 1000 * HOUR + 9000)], LINE, f"{scratch}/d")
    put(spark, [order(None, T0 + 2000 * HOUR)], ORDER, f"{scratch}/o")
    put(spark, [line(None, None, T0 + 2000 * HOUR)], LINE, f"{scratch}/d")
    q = jobs.sale_dead_letters_query(*streams(spark, scratch), f"{scratch}/dead", f"{scratch}/ck", trigger=ONCE)
    q.awaitTermination()
    tens = [f"{k}{n:02d}" for k in range(3) for n in range(0, 100, 10)]
    got = sorted((r.side, r.id) for r in spark.read.parquet(f"{scratch}/dead").where("id is not null").collect())
    assert got == sorted([("order", t) for t in tens] + [("order_detail", f"{t}_1") for t in tens])
    assert max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress) == 0
    assert max(kept(spark, scratch)) <= 6  # x, y and z, both sides


def test_once_per_key_picks_where_keys_repeat(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 4, "p"), (None, 3, "q"), ("b", 9, None)], "k string, n int, v string")
    assert sorted((r.k or "", r.v) for r in once_per_key(df, ["k"], ["n"]).collect()) == [("", "q"), ("a", "x"), ("b", None)]
    assert sorted((r.k or "", r.v) for r in once_per_key(df, ["k"], ["n"], latest=True).collect()) == [("", "p"), ("a", "y"), ("b", None)]
    assert "Sort" not in once_per_key(df.where(F.col("n") > 3).where("k is not null"), ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()


def test_refresh_of_late_users_merges_the_sale_rows_once(spark, scratch):
    table = KeyedTable(f"{scratch}/sales", ["order_detail_id"])
    row = ("1_1", "1", "O", "2024-01-01 10:00:00", "7", "s1", None, 0, None, 2.5, "red widget", "2024-01-01", "1")
    schema = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
              "sku_id string, user_gender string, user_age int, user_level string, sku_price double, "
              "sku_name string, dt string, sku_num string")
    table.write(spark.createDataFrame([row], schema), 0)
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"])
    users.write(spark.createDataFrame([("7", "u", "L1", "2000-08-02", "F", 1)], USER), 0)
    seen, write = [], table.repair

    def repair(df, *rest):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *rest)
    table.repair = repair
    jobs.refresh_missing_users(spark, table, users, "2001-08-02")
    assert table.view(spark).first().user_gender == "F"
    assert seen[0].count("order_detail_id#") and sum("Relation [" in x and "order_detail_id" in x for x in seen[0].splitlines()) == 1


def test_pending_job_looks_up_only_lines_whose_order_is_not_in_the_batch(spark, scratch):
    from livemart.plans.streams import pending_tables
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"], buckets=4)
    users.write(spark.createDataFrame([("7", "u", "L1", "1990-01-01", "F", 1)], USER), 0)
    for k in range(2):
        put(spark, [order(f"{k}{n}", T0) for n in range(20)], ORDER, f"{scratch}/o")
        put(spark, [line(f"{k}{n}_1", f"{k}{n}", T0) for n in range(20)] + [line(f"late_{k}", "03", T0)] * 2, LINE, f"{scratch}/d")
    stored, pending = pending_tables(scratch)
    table, asked, view = KeyedTable(f"{scratch}/sales", ["order_detail_id"]), [], stored.view

    def counted(session, keys=None, **rest):
        if keys is not None:
            asked.append(keys.distinct().count())
        return view(session, keys=keys, **rest)
    stored.view = counted
    jobs.pending_sale_query(*streams(spark, scratch), stored, pending, users, table, f"{scratch}/ck", "2001-08-02",
                            trigger=ONCE).awaitTermination()
    assert asked == [0, 1] and table.raw(spark).count() == 42 and pending.view(spark).count() == 0
    assert {r.user_gender for r in table.view(spark).collect()} == {"F"}


def test_large_bucket_is_written_by_several_tasks(spark, scratch):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key) for key in conf}
    rows = spark.range(0, 40_000, 1, 8).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    t = KeyedTable(f"{scratch}/t", ["k"], buckets=2)
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        t.write(rows, 0)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert t.raw(spark).select(F.input_file_name()).distinct().count() >= 8
    assert t.view(spark, keys=spark.createDataFrame([("7",)], "k string")).count() == 1 and t.view(spark).count() == 40_000


def test_alert_repair_computes_its_windows_and_alerts_once(spark, scratch):
    event = "event_id long, mid string, uid string, evid string, itemid string, ts_ms long"
    alert = ("id string, mid string, uids array<string>, itemIds array<string>, events array<string>, ts long, "
             "window_start string, window_end string, ok boolean")
    rows = [(k, "a", f"u{k}", "coupon", str(k), T0 + k) for k in range(3)]
    events = spark.createDataFrame(rows, event)
    table, late = KeyedTable(f"{scratch}/alerts", ["mid", "ts"], keep="ok", schema=alert), KeyedTable(f"{scratch}/late", ["event_id"])
    late.write(events, 0)
    seen, repair = [], table.repair

    def watched(df, *rest):
        seen.append(df._jdf.queryExecution().withCachedData().toString())
        repair(df, *rest)
    table.repair = watched
    jobs.repair_alerts(spark, table, lambda _: events, late, 30_000, 5_000)
    assert table.view(spark).count() == 6
    assert "InMemoryRelation" in seen[0]
