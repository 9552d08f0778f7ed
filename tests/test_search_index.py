"""The inverted index against brute force and the scan search, and what it reads."""

import math
import random

from pyspark.sql import functions as F

from livemart.operators import search
from livemart.operators.search_index import B, K1, SaleIndex, postings
from livemart.schemas import SALE_DETAIL_COLUMNS

SALE = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, sku_id string, "
        "user_gender string, user_age int, user_level string, sku_price double, sku_name string, dt string, sku_num string")


def sales(spark, n=300):
    rng = random.Random(11)
    words = ["red", "Widget", "small", "手机", "x9", "new", "bolt"]
    rows = []
    for k in range(n):
        name = rng.choice([None, "", " -- ", " ".join(rng.choice(words) for _ in range(rng.randint(1, 7)))] + [
            " ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(9)])
        rows.append((f"{k % 280:03d}", "1", "O", "t", "u", "s", rng.choice(["M", "F", None]), rng.randint(10, 50), rng.choice("AB"),
                     1.5, name, rng.choice(["2024-01-01", "2024-01-02"]), "1"))
    seen = {}
    for r in rows:
        seen[r[0]] = r
    return spark.createDataFrame(list(seen.values()), SALE), list(seen.values())


def split(name):
    out, word = [], ""
    for c in (name or "").lower() + " ":
        han = "一" <= c <= "鿿"
        if c.isalnum() and not han:
            word += c
            continue
        if word:
            out.append(word)
            word = ""
        if han:
            out.append(c)
    return out


def brute(rows, terms, date=None):
    docs = [split(r[10]) for r in rows]
    n = sum(bool(d) for d in docs)
    average = sum(map(len, docs)) / n
    df = {t: sum(t in d for d in docs) for t in terms}
    out = {}
    for r, d in zip(rows, docs):
        if all(t in d for t in terms) and (date is None or r[11] == date):
            score = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * d.count(t) * (K1 + 1)
                        / (d.count(t) + K1 * (1 - B + B * len(d) / average)) for t in terms)
            out[r[0]] = (sum(d.count(t) for t in terms), round(score, 9))
    return out


def test_matches_and_relevance_by_brute_force(spark, scratch):
    df, rows = sales(spark)
    index = SaleIndex.build(df, f"{scratch}/index")
    for keyword, terms in (("widget", ["widget"]), ("Widget RED", ["widget", "red"]), ("手机", ["手", "机"]),
                           ("new red small", ["new", "red", "small"]), ("nothing", ["nothing"])):
        for date in (None, "2024-01-01"):
            want = brute(rows, terms, date)
            got = {r.order_detail_id: (r.score, r.bm25) for r in index.matches(keyword, date).collect()}
            assert got.keys() == want.keys()
            assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-9 for k in want)
    assert index.matches("  ", None).count() == 0
    page = index.page(index.matches("red"), df, 1, 7, by="bm25").collect()
    best = sorted(brute(rows, ["red"]).items(), key=lambda x: (-x[1][1], x[0]))[:7]
    assert sorted(r.order_detail_id for r in page) == sorted(k for k, _ in best)


def test_response_equals_the_scan_search(spark, scratch):
    df, _ = sales(spark)
    index = SaleIndex.build(df, f"{scratch}/index")
    for keyword, date in (("red", "2024-01-01"), ("widget small", "2024-01-02"), ("nothing", "2024-01-01")):
        for page in (1, 2):
            scan = search.result(search.search(df, date, keyword), page, 5).first()
            own = index.result(df.where(F.col("dt") == date).select(*SALE_DETAIL_COLUMNS), keyword, date, page, 5).first()
            assert own.total == scan.total and own.stat == scan.stat
            assert [r.order_detail_id for r in own.detail] == [r.order_detail_id for r in scan.detail]


def test_search_reads_the_postings_of_its_terms(spark, scratch):
    df, _ = sales(spark)
    index = SaleIndex.build(df, f"{scratch}/index")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # the scan's filters in full
    try:
        plan = index.matches("widget red", "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "postings" in scans[0]
    pushed = scans[0].split("PushedFilters")[1]
    assert "In(term, [" in pushed and "widget" in pushed and "EqualTo(dt,2024-01-01)" in pushed
    held = index.postings()
    assert held.count() == postings(df).count()
    files = held.select(F.input_file_name().alias("f"), "term").distinct().groupBy("f").agg(
        F.min("term").alias("a"), F.max("term").alias("b")).orderBy("a").collect()
    assert all(x.b <= y.a for x, y in zip(files, files[1:]))  # ranges: each file holds its own stretch of terms


def test_index_of_an_empty_table(spark, scratch):
    df, _ = sales(spark)
    index = SaleIndex.build(df.limit(0), f"{scratch}/index")
    assert index.matches("red").count() == 0
    assert index.result(df.limit(0).select(*SALE_DETAIL_COLUMNS), "red", "2024-01-01", 1, 5).first().total == 0


def test_index_is_built_from_one_pass_over_the_sale_rows(spark, scratch):
    df, rows = sales(spark)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    index = SaleIndex.build(df.mapInArrow(counted, df.schema), f"{scratch}/index")
    assert index.postings().count() == postings(df).count() and seen.value == len(rows)


def test_narrow_view_merges_its_columns_only(spark, scratch):
    from livemart.streaming.upsert import KeyedTable
    t = KeyedTable(f"{scratch}/t", ["k"], keep="ok")
    for batch, v in ((0, "a"), (1, "b")):
        t.write(spark.createDataFrame([("x", v, "wide", True), ("y", v, "wide", batch == 0)], "k string, v string, w string, ok boolean"), batch)
    view = t.view(spark, columns=["k", "v"])
    assert [tuple(r) for r in view.collect()] == [("x", "b")] and view.columns == ["k", "v"]
    assert "w, w#" not in view._jdf.queryExecution().optimizedPlan().toString()


def test_stored_months_are_dealt_by_size(spark, scratch):
    from conftest import SF_SMALL
    from livemart.plans.streams import stored_sales
    # so that the small table is large
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        table = stored_sales(spark, SF_SMALL, f"{scratch}/sales")
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    tasks = {r.f.rsplit("/", 1)[1][:10] for r in table.raw(spark).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(tasks) > 2 * spark.sparkContext.defaultParallelism
