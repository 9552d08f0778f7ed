"""Physical-plan checks: no cartesian products, map-side combine, pruning, pushdown."""

import pytest

from conftest import SF_SMALL
from livemart.plans.catalog import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_nested_loop_or_python(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, p
    assert not any(n in p for n in PYTHON_NODES), p


def test_dau_combines_map_side_and_prunes_columns(spark):
    p = plan(QUERIES["dau_first"](spark, SF_SMALL))
    assert "partial_min_by" in p
    scan = [l for l in p.splitlines() if "FileScan parquet" in l][0]
    assert "value" not in scan.split("ReadSchema")[1]


def test_search_prunes_partitions_of_stored_table(spark, scratch):
    from livemart.operators import search
    QUERIES["sale_detail"](spark, SF_SMALL).write.partitionBy("dt").parquet(f"{scratch}/sale")
    stored = spark.read.parquet(f"{scratch}/sale")
    p = plan(search.search(stored, "1997-02-01", "widget"))
    assert "PartitionFilters: [isnotnull(dt" in p and "1997-02-01" in p


def test_batch_alert_does_not_replicate_events_per_window(spark):
    p = plan(QUERIES["coupon_alert_windows"](spark, SF_SMALL))
    assert "Expand" not in p


def test_cluster_conf_sizes_partitions():
    from livemart.session import cluster_conf
    c = cluster_conf(total_cores=8000, input_bytes=100 * (1 << 40))
    assert int(c["spark.sql.shuffle.partitions"]) == 400 * 1024  # 100 TB / 256 MB, no cap
    assert int(cluster_conf(64, 1 << 30)["spark.sql.shuffle.partitions"]) == 192  # 3 waves of cores


def test_raw_search_pushes_a_day_range_to_the_orders_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # the scan's filters in full
    try:
        p = plan(QUERIES["sale_total"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [l for l in p.splitlines() if "FileScan parquet" in l and "o_orderdate" in l][0]
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThan(o_orderdate" in scan


def test_stored_search_prunes_months_and_pushes_the_day(spark, scratch):
    from livemart.operators import search
    from livemart.plans.streams import stored_sales
    sales = stored_sales(spark, SF_SMALL, f"{scratch}/sales").view(spark)
    p = plan(search.search(sales.where("month = '1997-02'"), "1997-02-01", "widget"))
    scan = [l for l in p.splitlines() if "FileScan parquet" in l][0]
    assert "1997-02)" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(dt,1997-02-01)" in scan


def test_alert_decision_gathers_nothing_before_its_filter(spark):
    """Sets and lists are built only above the join with the alerting windows."""
    p = QUERIES["coupon_alert_windows"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = p.splitlines()
    join = min(i for i, l in enumerate(lines) if "Join " in l)
    assert not any("collect_" in l for l in lines[join:]), p


def test_search_filters_reach_the_scans(spark):
    df = QUERIES["sale_total"](spark, SF_SMALL)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # the keyword test sits directly on the part relation, the day test on orders
    lines = p.splitlines()
    kw = [i for i, l in enumerate(lines) if "regexp_extract_all" in l and "Filter" in l]
    assert kw and "p_name" in lines[kw[0]]
    day = [l for l in lines if "Filter" in l and "1997-02-01" in l]
    assert day and "o_orderdate" in day[0]


def test_province_counts_before_customer_join(spark):
    p = QUERIES["province_sales"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = p.splitlines()
    join = min(i for i, l in enumerate(lines) if "Join LeftOuter" in l and "user_id" in l)
    agg_below = [l for l in lines[join:] if "Aggregate [user_id" in l]
    assert agg_below, p
