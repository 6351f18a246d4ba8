"""Direct tests for the small operators of the inventory."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from gridpulse.functions import json_struct
from gridpulse.operators.aggregate import day_totals, multi_sum
from gridpulse.operators.clean import (distinct_values, drop_incomplete, fill_constant, to_kwh)
from gridpulse.sources.readers import normalise_columns, snake_columns, write_table
from conftest import rows


def test_column_name_normalisation(spark):
    df = spark.createDataFrame([(1, 2.0)], "` LAU-1 code 1 ` int, `Total Area (km²)` double")
    assert normalise_columns(df).columns == ["lau-1 code 1", "total area (km²)"]
    df2 = spark.createDataFrame([(1, "x")], "`PowerRegion` int, `Population (2012-01-01)` string")
    assert snake_columns(df2).columns == ["power_region", "population_2012_01_01"]


def test_fill_drop_distinct_kwh(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 2.0, "a"), (3, None, None)], "k int, v double, g string")
    assert [r["v"] for r in rows(fill_constant(df, ["v"], 0.0), "k")] == [0.0, 2.0, 0.0]
    assert [r["k"] for r in rows(drop_incomplete(df, ["v"]), "k")] == [2]
    assert {r["g"] for r in rows(distinct_values(df, "g"))} == {None, "a"}
    assert rows(df.filter("k = 2").select(to_kwh("v"))) == [{"total_kwh": 2000.0}]


def test_multi_sum_and_per_day_totals(spark):
    t = [dt.datetime(2022, 1, 1, 5), dt.datetime(2022, 1, 1, 6), dt.datetime(2022, 1, 2, 0)]
    df = spark.createDataFrame([(t[0], 1, 1.0, None), (t[1], 1, 2.0, 4.0), (t[2], 1, 3.0, 1.0)],
                               "ts timestamp_ntz, k int, a double, b double")
    assert rows(multi_sum(df, ["a", "b"])) == [{"a": 6.0, "b": 5.0}]
    got = rows(day_totals(df, ["k"], "ts", "a", with_day=True), "day")
    assert [(r["day"], r["total"]) for r in got] == [(dt.date(2022, 1, 1), 3.0), (dt.date(2022, 1, 2), 3.0)]


def test_typed_json_and_sink(spark):
    df = spark.createDataFrame([('{"temp": 1.5, "coco": 3}',), ("bad",)], "s string")
    got = rows(df.select(json_struct("s", "temp double, coco int").alias("j")).select("j.*"))
    assert got[0] == {"temp": 1.5, "coco": 3} and got[1] == {"temp": None, "coco": None}
    out = os.path.join(tempfile.mkdtemp(prefix="gp-sink-"), "t")
    data = spark.createDataFrame([("2022-01", 1.0), ("2022-02", 2.0)], "month string, v double")
    write_table(data, out, partition_by=["month"])
    assert {"month=2022-01", "month=2022-02"} <= set(os.listdir(out))
    assert spark.read.parquet(out).count() == 2


def test_spoiled_documents_are_kept_as_text(spark, tmp_path):
    from gridpulse.sources.readers import read_documents, split_documents, typed_municipalities

    lines = ['{"LAU-1 code 1": "1", "Municipality": "A", "Latitude": 5, "more": {"x": 1}}', '{"LAU-1 code 1": "2", "Muni', "", "not json",
             '{"LAU-1 code 1": "x", "Latitude": 1.5}', '{"LAU-1 code 1": "3", "Latitude": "north"}', "{}", "  "]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/d")
    good, bad = split_documents(read_documents(spark, f"{tmp_path}/d", corrupt="bad"), "bad")
    assert {r["bad"] for r in rows(bad)} == {lines[1], lines[3], lines[5]} and bad.select("bad").count() == 3
    got = {(r["lau_1_code_1"], r["municipality"], r["latitude"]) for r in rows(typed_municipalities(good))}
    assert got == {(1, "A", 5.0), (None, None, 1.5), (None, None, None)} and good.count() == 3


def test_missing_measure_is_an_error(spark):
    import pytest

    from gridpulse.plans.dashboard import hourly_series, production_map

    df = spark.createDataFrame([(1, 2.0)], "municipality_number int, solar_power_mwh double")
    for call in (lambda: production_map(df, df, "2022-01-01", "no_such"), lambda: hourly_series(df, ["municipality_number"], "hour_utc", "no_such")):
        with pytest.raises(ValueError, match="no_such"):
            call()


def test_series_with_hour_keeps_null_keys(spark):
    import datetime as dt

    from gridpulse.operators.joins import series_with_hour

    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    df = spark.createDataFrame([("a", t[0]), ("a", t[1]), ("b", t[1]), (None, t[0]), (None, t[2])], "k string, t timestamp_ntz")
    assert sorted((str(r["k"]), r["t"].hour) for r in rows(series_with_hour(df, ["k"], "t", t[0]))) == [("None", 0), ("None", 2), ("a", 0), ("a", 1)]
