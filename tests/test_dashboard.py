import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from gridpulse.plans import dashboard as Q
from gridpulse.sources.readers import (read_documents, read_table, typed_municipalities,
                                       typed_production, typed_weather)
from gridpulse.operators.clean import null_profile, replace_values
from gridpulse.sources.dims import MUNICIPALITY_ALIASES
from conftest import rows

MUNI_DOCS = [
    {"LAU-1 code 1": "101", "Municipality": "København", "Administrative Center": "Copenhagen",
     "Total Area (km²)": 90.1, "Population (2012-01-01)": 549050, "Region": "Hovedstaden",
     "Latitude": 55.67, "Longitude": 12.57, "PowerRegion": "DK2", "extra": "dropped"},
    {"LAU-1 code 1": "751", "Municipality": "Aarhus", "Administrative Center": "Aarhus",
     "Total Area (km²)": 468.0, "Population (2012-01-01)": 314545, "Region": "Midtjylland",
     "Latitude": 56.15, "Longitude": 10.21, "PowerRegion": "DK1"},
    {"LAU-1 code 1": "999", "Municipality": "Nowhere", "Administrative Center": "None",
     "Total Area (km²)": 1.0, "Population (2012-01-01)": 1, "Region": "X",
     "Latitude": 55.0, "Longitude": 9.0, "PowerRegion": "DK1"},
]


def _munis(spark):
    d = tempfile.mkdtemp(prefix="gp-docs-")
    p = os.path.join(d, "m.json")
    with open(p, "w", encoding="utf-8") as f:
        for doc in MUNI_DOCS:
            f.write(json.dumps(doc, ensure_ascii=False) + "\n")
    raw = read_documents(spark, p)
    assert "extra" not in raw.columns and len(raw.columns) == 9
    return typed_municipalities(raw)


def _weather(spark):
    data = [("2022-01-01 00:00:00", "Copenhagen", None, '{"temp": 1.0}'),
            ("2022-01-01 01:00:00", "Copenhagen", 4.2, '{"temp": 2.0}'),
            ("2022-01-01 02:00:00", "Copenhagen", 4.2, '{"temp": 2.0}'),
            ("2022-01-01 00:00:00", "Aarhus", 1.5, '{"temp": 3.0}'),
            ("bad", "Aarhus", 9.9, '{"temp": 3.0}'),
            (None, "Aarhus", 9.9, None),
            ("2022-12-31 23:59:59", "Aarhus", 1.5, '{"temp": 4.0}'),
            ("2023-01-01 00:00:00", "Aarhus", 1.5, '{"temp": 4.0}')]
    return typed_weather(spark.createDataFrame(
        data, "timestamp string, municipality string, distance_to_station_km double, weather_data string"))


def test_clean_weather_window(spark):
    got = rows(Q.clean_weather(_weather(spark)), "timestamp")
    assert len(got) == 5
    assert got[-1]["timestamp"] == dt.datetime(2022, 12, 31, 23, 59, 59)


def test_municipality_profile_with_alias(spark):
    m = _munis(spark)
    assert dict(m.dtypes)["lau_1_code_1"] == "int"
    w = Q.clean_weather(_weather(spark))  # still says "Copenhagen": the profile canonicalises
    got = {r["municipality"]: r for r in rows(Q.municipality_profile(m, w))}
    same = rows(Q.municipality_profile(m, replace_values(w, "municipality", MUNICIPALITY_ALIASES)),
                "municipality")
    assert [r["distance_to_station_km"] for r in same] == \
        [got[r["municipality"]]["distance_to_station_km"] for r in same]
    assert got["København"]["distance_to_station_km"] == 4.2
    assert got["Aarhus"]["distance_to_station_km"] == 1.5
    assert got["Nowhere"]["distance_to_station_km"] is None
    assert got["Nowhere"]["hover_text"].endswith("Region: X<br>")
    assert got["Aarhus"]["hover_text"].endswith("<br>Distance to Station (km): 1.5")
    assert got["Aarhus"]["hover_text"].startswith("Aarhus<br>Latitude: 56.15<br>Longitude: 10.21")


def _production(spark):
    h = [dt.datetime(2022, 1, 2, i) for i in range(3)]
    data = [(str(h[0]), 101, 1.0, None, 2.0, 0.0, 5.0), (str(h[1]), 101, None, None, 4.0, 0.0, float("nan")),
            (str(h[2]), 101, 3.0, None, 6.0, 0.0, 7.0), (str(h[0]), 751, 10.0, 1.0, 1.0, 0.0, 0.0),
            ("garbage", 751, 1.0, 1.0, 1.0, 1.0, 1.0)]
    return typed_production(spark.createDataFrame(
        data, "hour_utc string, municipality_number int, offshore_wind_mwh_gte_100 double, "
              "offshore_wind_mwh_lt_100 double, onshore_wind_power_mwh double, solar_power_mwh double, "
              "thermal_power_production double"))


def test_production_map_and_clean_hourly(spark):
    p = _production(spark)
    prof = {r["measure"]: r for r in rows(null_profile(p, ["offshore_wind_mwh_lt_100",
                                                           "thermal_power_production"]))}
    assert prof["offshore_wind_mwh_lt_100"]["n_null"] == 3
    assert prof["thermal_power_production"]["n_null"] == 1  # NaN read as NULL at load
    filled = Q.clean_hourly(p.filter(F.col("hour_utc").isNotNull()), ["municipality_number"], "hour_utc",
                            ["offshore_wind_mwh_gte_100", "thermal_power_production"])
    f = rows(filled.filter("municipality_number = 101"), "hour_utc")
    assert [r["offshore_wind_mwh_gte_100"] for r in f] == [1.0, 2.0, 3.0]
    assert [r["thermal_power_production"] for r in f] == [5.0, 6.0, 7.0]
    m = _munis(spark)
    dim = Q.municipality_profile(m, Q.clean_weather(_weather(spark)))
    got = {r["code"]: r for r in rows(Q.production_map(p, dim, "2022-01-02", "onshore_wind_power_mwh"))}
    assert got[101]["total_mwh"] == 12.0 and got[751]["total_mwh"] == 1.0 and got[999]["total_mwh"] == 0.0
    assert got[101]["total_kwh"] == 12000.0 and got[101]["palette"] == "Teal"
    assert "Power Production: 12000.00 kWh<br>Selected Day: 2022-01-02" in got[101]["text"]
    assert got[101]["scale"] == 1.0 and got[999]["scale"] == 0.0


def test_consumption_map_group(spark):
    h = dt.datetime(2022, 1, 2, 3)
    c = spark.createDataFrame([(h, 101, "Privat", 5.0), (h, 101, "Erhverv", 50.0), (h, 751, "Privat", 1.0)],
                              "hour_utc timestamp_ntz, municipality_number int, industry_groups string, "
                              "consumption_kwh double")
    dim = spark.createDataFrame([(101, "K"), (751, "A"), (999, "N")], "lau_1_code_1 int, hover_text string")
    got = {r["code"]: r for r in rows(Q.consumption_map(c, dim, "2022-01-02", group="Privat"))}
    assert got[101]["total_kwh"] == 5.0 and got[999]["total_kwh"] == 0.0
    assert got[101]["palette"] == "Oranges" and got[101]["scale"] == 1.0
    assert got[751]["scale"] == 0.3 or got[751]["scale"] < 1.0
    allg = {r["code"]: r["total_kwh"] for r in rows(Q.consumption_map(c, dim, "2022-01-02"))}
    assert allg[101] == 55.0


def test_calendar_marks(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 1, 3),), (dt.datetime(2022, 12, 31, 22),)], "ts timestamp_ntz")
    cal = rows(Q.calendar_marks(df, "ts"), "day_number")
    assert len(cal) == 365 and cal[0]["label"] == "January 01"
    assert cal[60]["label"] == "March 02" and cal[59]["label"] is None


def test_read_table_parquet(spark):
    ev = read_table(spark, "/root/testdata/sf0.001/events.parquet")
    assert "ts" in ev.columns


def test_production_map_with_text_keys(spark):
    h = dt.datetime(2022, 1, 2, 3)
    p = spark.createDataFrame([(h, "a", 4.0), (h, "b", 1.0)],
                              "hour_utc timestamp_ntz, municipality_number string, solar_power_mwh double")
    dim = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "lau_1_code_1 string, hover_text string")
    got = {r["code"]: r["scale"] for r in rows(Q.production_map(p, dim, "2022-01-02", "solar_power_mwh"))}
    assert got["a"] == 1.0 and got["b"] == 0.0 and got["c"] == 0.0
