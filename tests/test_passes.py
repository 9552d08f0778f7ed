"""Work in passes: the same rows, and disk that is given back as the work goes on."""

import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from livemart import passes
from livemart.operators.search_index import SaleIndex, postings
from livemart.streaming import jobs, upsert
from livemart.streaming.replay import replay_stream, to_chunks
from livemart.streaming.upsert import KeyedTable
from test_bounded import HOUR, LINE, ORDER, T0, USER, line, order, put, run_sales
from test_search_index import sales

ONCE = {"availableNow": True}


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(k) for k in range(files.size())]
    return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle_")}


def left_behind(spark, work):
    """Bytes of shuffle files that ``work`` leaves (Spark removes them a moment after the query)."""
    before = shuffle_bytes(spark)
    work()
    for _ in range(50):
        left = sum(n for f, n in shuffle_bytes(spark).items() if f not in before)
        if left == 0:
            break
        time.sleep(0.1)
    return left


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(passes, "PASS_ROWS", 7)


def test_replay_leaves_its_slices_only(spark, scratch):
    a = spark.range(4000).select(F.col("id"), (F.col("id") * 10).alias("ms"), F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("k"))
    df = a.join(spark.range(4000).repartition(3), "id")
    persisted = spark._jsc.sc().getPersistentRDDs().size()
    assert left_behind(spark, lambda: to_chunks(df, f"{scratch}/in", "ms", 2, 2, pass_by="k", passes=3)) == 0
    assert spark._jsc.sc().getPersistentRDDs().size() == persisted
    back = spark.read.schema(df.schema).parquet(f"{scratch}/in")
    assert back.count() == 4000 and back.exceptAll(df).count() == 0
    assert back.select(F.input_file_name()).distinct().count() == 4
    with pytest.raises(AnalysisException):  # the staged copy
        spark.read.schema(df.schema).parquet(f"{scratch}/in_staged")


def test_replay_spends_the_files_of_committed_batches(spark, scratch):
    df = spark.range(400).select("id", F.col("id").alias("ms"))
    table = KeyedTable(f"{scratch}/t", ["id"])
    src = replay_stream(df, f"{scratch}/in", "ms", 4, 2, spend=True)
    src.writeStream.foreachBatch(table.foreach_batch()).option("checkpointLocation", f"{scratch}/ck").trigger(**ONCE).start().awaitTermination()
    time.sleep(1)
    assert table.view(spark).count() == 400
    assert spark.read.schema(df.schema).parquet(f"{scratch}/in").count() == 100  # the last batch's


def test_sale_job_leaves_no_shuffle_files(spark, scratch):
    put(spark, [order(n, T0 + n * HOUR) for n in range(50)], ORDER, f"{scratch}/o")
    put(spark, [line(f"{n}_1", n, T0 + n * HOUR) for n in range(50)], LINE, f"{scratch}/d")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert left_behind(spark, lambda: run_sales(spark, scratch)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_restart_replays_the_uncommitted_batch_of_a_spent_replay(spark, scratch):
    from livemart.plans.streams import CrashingTable, _run_through_crash
    o = spark.createDataFrame([order(n, T0 + n * HOUR) for n in range(80)], ORDER)
    d = spark.createDataFrame([line(f"{n}_1", n, T0 + n * HOUR) for n in range(80)], LINE)
    src = [replay_stream(df, f"{scratch}/{name}", t, 4, 2, spend=True) for df, name, t in ((o, "o", "order_ms"), (d, "d", "change_ms"))]
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"], buckets=4)
    users.write(spark.createDataFrame([("7", "u", "L1", "1990-01-01", "F", 1)], USER), 0)
    table = CrashingTable(f"{scratch}/sales", ["order_detail_id"])
    table.crash_at = 2
    _run_through_crash(lambda: jobs.sale_query(*src, users, table, f"{scratch}/ck", "2001-08-02", trigger=ONCE))
    time.sleep(1)
    assert table.raw(spark).count() == 80 and table.view(spark, few_repeats=True).count() == 80
    assert spark.read.schema(o.schema).parquet(f"{scratch}/o").count() == 20  # the last batch's


def versions(spark, path):
    t = KeyedTable(path, ["d", "k"], order=["n"])
    t.write(spark.createDataFrame([("x", str(k), 1, "a") for k in range(40)] + [(None, "q", 1, "a"), ("x", None, 2, "b"), (None, None, 1, "a")],
                                  "d string, k string, n int, v string"), 0)
    t.write(spark.createDataFrame([("x", "3", 2, "c"), ("x", None, 1, "c"), (None, None, 1, "c")], "d string, k string, n int, v string"), 1)
    return t


def test_view_moves_only_rows_of_repeated_keys(spark, scratch, monkeypatch):
    t = versions(spark, f"{scratch}/t")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(t.view(spark, few_repeats=True)) == rows(t.view(spark)) and t.view(spark, few_repeats=True).count() == 43
    monkeypatch.setattr(upsert, "MAX_REPEATS", 2)
    assert rows(t.view(spark, few_repeats=True)) == rows(t.view(spark))
    single = KeyedTable(f"{scratch}/s", ["k"])
    single.write(spark.range(100).select(F.col("id").cast("string").alias("k")), 0)
    assert "Exchange" not in single.view(spark, few_repeats=True)._jdf.queryExecution().executedPlan().toString()


def test_compaction_in_passes_folds_repairs(spark, scratch, small):
    t = versions(spark, f"{scratch}/t")
    fix = lambda v: spark.createDataFrame([("x", "5", 1, v, 0), ("x", "late", 1, v, 0), ("x", "3", 2, v, 1)],
                                          "d string, k string, n int, v string, batch_id long")
    t.repair(fix("r"), 1, "some")
    want = sorted(map(str, t.view(spark).collect()))
    t.compact(spark, 1)
    assert t.raw(spark).count() == 44 and sorted(map(str, t.view(spark).collect())) == want
    t.write(spark.createDataFrame([("x", "7", 9, "new")], "d string, k string, n int, v string"), 2)
    assert {r.k: r.v for r in t.view(spark).where("k in ('3', '5', '7', 'late')").collect()} == {"3": "r", "5": "r", "7": "new", "late": "r"}
    # run again, it corrects what is there now
    t.repair(fix("again").where("k = '3'"), 1, "some")
    assert t.view(spark).where("d = 'x' and k = '3'").first().v == "again"
    t.compact(spark, 2)
    assert t.view(spark).where("d = 'x' and k = '3'").first().v == "again" and t.view(spark).count() == 44


def test_refresh_of_late_users_in_passes(spark, scratch, small):
    table = KeyedTable(f"{scratch}/sales", ["order_detail_id"])
    schema = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
              "sku_id string, user_gender string, user_age int, user_level string, sku_price double, "
              "sku_name string, dt string, sku_num string")
    table.write(spark.createDataFrame([(f"{k}_1", str(k), "O", "2024-01-01 10:00:00", str(k % 3), "s1", None, 0, None, 2.5, "red",
                                        "2024-01-01", "1") for k in range(30)], schema), 0)
    users = KeyedTable(f"{scratch}/users", ["id"], order=["seq"])
    users.write(spark.createDataFrame([(str(k), "u", "L1", "2000-08-02", "F", 1) for k in range(2)], USER), 0)
    assert left_behind(spark, lambda: jobs.refresh_missing_users(spark, table, users, "2001-08-02", 1)) == 0
    jobs.refresh_missing_users(spark, table, users, "2001-08-02", 1)  # a second run replaces the first
    table.compact(spark, table.next_batch(spark) - 1)
    assert table.raw(spark).count() == 30
    assert sorted((r.user_id, r.user_gender) for r in table.view(spark, few_repeats=True).select("user_id", "user_gender").distinct().collect()) == [
        ("0", "F"), ("1", "F"), ("2", None)]


def test_index_in_ranges_equals_the_index_of_one_pass(spark, scratch, monkeypatch):
    df, rows = sales(spark)
    df = df.unionByName(df.limit(3).withColumns({"dt": F.lit(None).cast("string"), "order_detail_id": F.lit(None).cast("string")}))
    whole = SaleIndex.build(df, f"{scratch}/whole")
    persisted = spark._jsc.sc().getPersistentRDDs().size()
    monkeypatch.setattr(passes, "PASS_ROWS", 150)
    assert left_behind(spark, lambda: SaleIndex.build(df, f"{scratch}/parts")) == 0
    parts = SaleIndex(spark, f"{scratch}/parts")
    assert spark._jsc.sc().getPersistentRDDs().size() == persisted
    assert len(passes.in_ranges(parts.postings(), ["term"], parts.postings().count())) > 4
    for name in ("postings", "terms", "collection"):
        a, b = (spark.read.parquet(f"{x.path}/{name}") for x in (whole, parts))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert parts.postings().count() == postings(df).count()
    files = parts.postings().select(F.input_file_name().alias("f"), "term").distinct().groupBy("f").agg(
        F.min("term").alias("a"), F.max("term").alias("b")).orderBy("a", "b").collect()
    assert len(files) > 4 and all(x.b <= y.a for x, y in zip(files, files[1:]))
    with pytest.raises(AnalysisException):
        spark.read.schema("term string").parquet(f"{scratch}/parts/staged")


def test_stored_sales_in_passes(spark, scratch, monkeypatch):
    from conftest import SF_SMALL
    from livemart.plans.catalog import sale_detail
    from livemart.plans.streams import stored_sales
    want = sale_detail(spark, SF_SMALL)
    monkeypatch.setattr(passes, "PASS_ROWS", 2000)
    tables = []
    assert left_behind(spark, lambda: tables.append(stored_sales(spark, SF_SMALL, f"{scratch}/sales"))) == 0
    got = tables[0].raw(spark).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    part = passes.in_passes(want, ["order_id"], 3)[0]._jdf.queryExecution().optimizedPlan().toString()
    # each pass filters the lines and the orders before the join moves them
    assert part.count("pmod(xxhash64(") >= 2
