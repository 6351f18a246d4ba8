"""Plan-shape checks: pushdown, pruning, no driver round trips."""

import os
import datetime as dt
import re

import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF_SMALL
from scripts.plan_report import final_plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_filter_reaches_scan(spark):
    plan = _plan(entry.queries()["entity_day_total"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", plan)


def test_points_need_no_shuffle(spark):
    plan = _plan(entry.queries()["region_points"](spark, SF_SMALL))
    assert "Exchange" not in plan


def test_library_never_collects():
    bad = re.compile(r"\.(collect|toPandas|toLocalIterator|rdd)\(|(?<!\bF)\.(first|count)\(|\.rdd\b|localCheckpoint")
    for base, _, files in os.walk(os.path.join(ROOT, "gridpulse")):
        if os.path.basename(base) == "llm":  # optional, with tests of its own
            continue
        for f in files:
            if f.endswith(".py"):
                src = open(os.path.join(base, f), encoding="utf-8").read()
                assert not bad.search(src), f


def test_no_cartesian_no_python_in_any_query(spark):
    """Every registered query stays JVM-side and never pairs rows blindly."""
    banned = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
              "MapInPandas", "PythonUDF")
    for name, fn in entry.QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        for b in banned:
            assert b not in plan, (name, b)
        if "BroadcastNestedLoopJoin" in plan:  # only against a broadcast side
            assert "BroadcastExchange" in plan, name


def test_weather_rows_not_shuffled_for_the_day_bounds(spark):
    """The per-day bounds (one row per day) are broadcast up front: after
    execution the final plan has no shuffle of the rows by day."""
    df = entry.queries()["json_property_zscore"](spark, SF_SMALL)
    df.collect()
    final = final_plan(df._jdf.queryExecution().executedPlan().toString())
    assert "Exchange hashpartitioning(coalesce(day" not in final


def test_final_plan_keeps_the_query_around_its_subqueries():
    text = "\n".join(["AdaptiveSparkPlan", "+- == Final Plan ==", "   Project", "   :  +- Subquery", "   :     +- == Final Plan ==", "   :        Agg",
                      "   :     +- == Initial Plan ==", "   :        Agg0", "   +- Scan", "+- == Initial Plan ==", "   Project0"])
    got = final_plan(text)
    assert "Scan" in got and "Agg0" not in got and "Project0" not in got


def test_bounded_series_are_dealt_once_by_their_key(spark):
    """Series with a proven bound: one exchange of the hourly rows by the series,
    no position windows, no second pass."""
    plan = _plan(entry.QUERIES["production_series"](spark, SF_SMALL))
    assert plan.count("FlatMapGroupsInArrow") == 1 and "Window" not in plan
    above = plan.split("FlatMapGroupsInArrow")[1].split("HashAggregate")[0]
    assert above.count("Exchange hashpartitioning(municipality_number") == 1


def test_long_series_rows_meet_their_result_in_their_cell(spark):
    """The four exchanges between the steps carry pieces; the rows are dealt to
    the cells and take the result there."""
    plan = _plan(entry.QUERIES["smooth_long_series"](spark, SF_SMALL))
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "SortMergeJoin [event_id" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(__gp_series#\d+, __gp_lane", plan)) == 6


@pytest.mark.parametrize("name", ["impute_series", "smooth_long_series"])
def test_scan_rows_are_dealt_once(spark, name):
    """Without broadcasts the rows of a scan are shuffled once after the hourly
    sums, by the cell; what else is shuffled by cell or series has one row per
    cell (or per cell and coefficient)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(entry.QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"Exchange hashpartitioning\(__gp_cell#\d+, \d+\), REPARTITION_BY_COL", plan)
    assert dealt
    below = plan.split("REPARTITION_BY_COL")[0]
    assert not re.search(r"hashpartitioning\(__gp_cell#\d+\.series", below.split("Window")[0])


@pytest.mark.parametrize("name", ["zone_exchange", "zone_share", "net_locations", "neighbour_utilisation",
                                  "neighbour_trade_literal", "country_share", "zone_dots"])
def test_exchange_queries_prune_by_time(spark, name):
    plan = _plan(entry.QUERIES[name](spark, SF_SMALL))
    scans = re.findall(r"PushedFilters: \[[^\n]*event_type[^\n]*", plan)
    assert scans and all(re.search(r"LessThan(OrEqual)?\(ts,", s) for s in scans)


def test_many_boxes_need_no_cartesian_product(spark):
    from gridpulse.operators.spatial import any_box_exists, points_in_boxes

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        boxes = spark.range(20_001).selectExpr("cast(id as string) location", "id % 300 - 150.0d lon_lo", "id % 300 - 149.0d lon_hi",
                                               "id % 160 - 80.0d lat_lo", "cast(null as double) lat_hi")
        points = spark.range(50).selectExpr("id", "id * 3.0d lon", "id * 1.5d lat")
        for df in (points_in_boxes(points, boxes), any_box_exists(points, boxes)):
            assert not re.search("CartesianProduct|NestedLoop", _plan(df))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_weather_map_reads_its_input_twice(spark):
    """Once for the statistics, whose table of values is shared, and once for the rows."""
    df = entry.QUERIES["json_property_zscore"](spark, SF_SMALL)
    df.collect()
    final = final_plan(df._jdf.queryExecution().executedPlan().toString())
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final


def test_catalog_tables_join_without_an_exchange_and_prune_months(spark, tmp_path):
    from gridpulse.plans.bindings import catalog_plan
    from gridpulse.sources.readers import save_hourly

    rows = spark.range(20_000).selectExpr("cast(id % 50 as int) municipality_number", "cast(id as decimal(18,2)) click",
                                          "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 300 as int)) hour_utc")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prod = save_hourly(rows, "t_production", f"{tmp_path}/p", "municipality_number", "hour_utc", buckets=4)
        dim = save_hourly(spark.range(60).selectExpr("cast(id as int) municipality_number", "cast(id as string) c_name"),
                          "t_dimension", f"{tmp_path}/d", "municipality_number", buckets=4)
        df = catalog_plan(spark, prod, dim)
        got = {r.municipality_number: (float(r.total_mwh), r.n_hours) for r in df.collect()}
        final = final_plan(df._jdf.queryExecution().executedPlan().toString())
        assert "Exchange hashpartitioning" not in final, final  # neither below the join nor for the sums
        assert "dynamicpruning" in final and "Bucketed: true" in final
        files = [f for d in (tmp_path / "p").iterdir() if d.is_dir() for f in d.iterdir() if f.name.startswith("part-")]
        assert len(files) <= 4 * 10  # a file a bucket and month
        read = re.search(r"numFiles|PartitionFilters: \[[^\]]*month", final)
        assert read
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists t_production")
        spark.sql("drop table if exists t_dimension")
    want = {}
    for i in range(20_000):
        if i % 300 < 91:
            t, n = want.get(i % 50, (0, 0))
            want[i % 50] = (t + i, n + 1)
    assert got == {k: want.get(k, (0.0, 0)) for k in range(60)}


def test_series_filter_reaches_the_fact_scan_as_a_bloom_filter(spark, tmp_path):
    from gridpulse.operators.joins import series_with_hour

    spark.range(50_000).selectExpr("id % 500 k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 500 + id div 500 as int)) t", "id v") \
        .write.parquet(f"{tmp_path}/facts")
    conf = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = series_with_hour(spark.read.parquet(f"{tmp_path}/facts"), ["k"], "t", dt.datetime(2024, 1, 1, 7))
        n = df.count()
        df.collect()
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert n == 8 * 100 and "might_contain" in plan
