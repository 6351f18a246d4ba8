import datetime as dt

from pyspark.sql import functions as F

from gridpulse.operators.exchange import (country_dim, daily_cumulative, neighbour_utilisation,
                                          net_locations, zone_country_exchange, zone_share,
                                          country_share, zone_summaries)
from gridpulse.operators.weather import property_day_zscore, station_property
from gridpulse.sources.dims import ENABLED_MUNICIPALITIES, trade_roles_frame
from conftest import rows

D1, D2 = dt.datetime(2022, 1, 2, 0), dt.datetime(2022, 1, 2, 1)
D0 = dt.datetime(2022, 1, 1, 5)


def _prodcon(spark):
    # gb: signed; ge: all positive; nl: all NULL; no: zero
    data = [(D0, "DK1", -5.0, 1.0, None, 0.0), (D1, "DK1", -2.0, 3.0, None, 0.0),
            (D2, "DK1", 4.0, 2.0, None, 0.0), (D1, "DK2", -1.5, 0.5, None, 0.0),
            (D1, "SE3", -100.0, 100.0, None, 0.0)]
    return spark.createDataFrame(data, "hour_utc timestamp_ntz, price_area string, exchangegb_mwh double, "
                                       "exchangege_mwh double, exchangenl_mwh double, exchangeno_mwh double")


def test_zone_country_exchange(spark):
    z = rows(zone_country_exchange(_prodcon(spark), country_dim(spark), "2022-01-02"), "price_area", "ord")
    assert len(z) == 8
    gb1 = [r for r in z if r["price_area"] == "DK1" and r["country"] == "Great Britain"][0]
    assert (gb1["import_mwh"], gb1["export_mwh"]) == (-2.0, 4.0)
    assert gb1["text"] == "Import from Great Britain: -2.00 MWh<br>Export to Great Britain: 4.00 MWh<br>"
    nl = [r for r in z if r["country"] == "Netherlands"]
    assert all(r["import_mwh"] == 0 and r["export_mwh"] == 0 for r in nl)
    s = rows(zone_summaries(zone_country_exchange(_prodcon(spark), country_dim(spark), "2022-01-02"),
                            trade_roles_frame(spark), "2022-01-02"), "name")
    assert s[0]["name"] == "DK1" and s[0]["text"].startswith("DK1<br>Daily values for Selected Day:2022-01-02 00:00:00<br>Import from Great Britain")


def test_neighbour_utilisation_and_shares(spark):
    pc = _prodcon(spark)
    n = {r["country"]: r for r in rows(neighbour_utilisation(pc, country_dim(spark), "2022-01-01",
                                                             year_end="2022-12-31"))}
    gb = n["Great Britain"]
    assert gb["cum_import"] == -5.0 and gb["cum_export"] == 0.0
    assert gb["year_import"] == -108.5 and gb["year_export"] == 4.0
    assert gb["current_use"] == 5.0 and gb["yearly_max"] == 112.5 and gb["level"] == "green"
    assert n["Norway"]["level"] == "red"  # 0 < 0 * max is false twice
    cs = rows(country_share(pc, country_dim(spark), "2022-12-31"), "country", "direction")
    ge = [r["share"] for r in cs if r["country"] == "Germany"]
    assert sorted(ge) == [0.0, 1.0]
    zs = rows(zone_share(pc, country_dim(spark), "2022-01-02"), "price_area", "country")
    by = {}
    for r in zs:
        if r["share"] is not None:
            by.setdefault((r["price_area"], r["country"]), 0.0)
            by[(r["price_area"], r["country"])] += r["share"]
    assert all(abs(v - 1.0) < 1e-12 for v in by.values())


def test_net_locations_and_daily(spark):
    pc = _prodcon(spark)
    got = {r["name"]: r["value"] for r in rows(net_locations(pc, country_dim(spark), "2022-01-02"))}
    assert got == {"Great Britain": 0.5, "Germany": 5.5}
    d = rows(daily_cumulative(pc, country_dim(spark)), "country", "day")
    gb = [r for r in d if r["country"] == "Great Britain"]
    assert gb[-1]["cum_import"] == -108.5 and gb[-1]["cum_export"] == 4.0


def test_weather_zscore(spark):
    t = [dt.datetime(2022, 1, 2, h) for h in range(4)]
    data = [(t[0], "Copenhagen", '{"temp": 1.0}'), (t[1], "Copenhagen", '{"temp": 3.0}'),
            (t[2], "Copenhagen", '{"temp": 2.0'), (t[3], "Copenhagen", '{"wspd": 2.0}'),
            (t[0], "Aarhus", '{"temp": 5.0}'), (t[0], "Vejle", '{"temp": 9.0}')]
    w = spark.createDataFrame(data, "timestamp timestamp_ntz, municipality string, weather_data string")
    obs = station_property(w, "timestamp", "municipality", "weather_data", "temp")
    out = rows(property_day_zscore(obs, "timestamp", enabled=ENABLED_MUNICIPALITIES), "municipality", "timestamp")
    assert {r["municipality"] for r in out} == {"København", "Aarhus"}
    kbh = [r for r in out if r["municipality"] == "København"]
    assert kbh[0]["day_sum"] == 4.0 and kbh[0]["mean"] == 2.0
    assert kbh[0]["scale"] == 0.3 or kbh[0]["scale"] == 1.0
    assert kbh[2]["value"] is None and kbh[2]["z_size"] is None and kbh[2]["color_index"] is None
    obs0 = station_property(w, "timestamp", "municipality", "weather_data", "temp", default=0.0)
    vals = [r["value"] for r in rows(obs0, "timestamp")]
    assert 0.0 in vals and None in vals


def test_literal_roles(spark):
    from gridpulse.operators.exchange import neighbour_trade_literal
    pc = _prodcon(spark)
    got = {r["country"]: r for r in rows(neighbour_trade_literal(pc, trade_roles_frame(spark), "2022-01-02",
                                                                 year_end="2022-12-31"))}
    assert set(got) == {"Germany", "Netherlands", "Norway", "Great Britain"}
    # Germany: export = net of exchangege_mwh, import = net of exchangenl_mwh (all NULL -> 0)
    assert got["Germany"]["cum_export"] == 106.5 and got["Germany"]["cum_import"] == 0.0
    # Great Britain swaps: import = net of exchangegb_mwh, export = net of exchangege_mwh
    assert got["Great Britain"]["cum_import"] == -104.5 and got["Great Britain"]["cum_export"] == 106.5
    assert got["Great Britain"]["day_import"] == 0.5


def test_select_helpers(spark):
    import pytest
    from gridpulse.operators.select import first_match, first_rows, select_measure, unpivot_measures
    pc = _prodcon(spark)
    assert select_measure(pc, ["hour_utc"], "exchangegb_mwh").columns == ["hour_utc", "value"]
    with pytest.raises(ValueError):
        select_measure(pc, ["hour_utc"], "exchangexx_mwh")
    top = rows(first_rows(pc, ["hour_utc", "price_area"], 2))
    assert [r["price_area"] for r in top] == ["DK1", "DK1"] and top[0]["hour_utc"] == D0
    fm = rows(first_match(pc, ["price_area"], ["hour_utc"], "exchangegb_mwh",
                          where=F.col("exchangegb_mwh") > 0))
    assert fm == [{"price_area": "DK1", "exchangegb_mwh": 4.0}]
    long = unpivot_measures(pc, ["hour_utc", "price_area"], ["exchangegb_mwh", "exchangenl_mwh"])
    assert long.count() == 5


def test_weather_all_missing_day_sums_to_zero(spark):
    t = dt.datetime(2022, 1, 2, 1)
    w = spark.createDataFrame([(t, "Aarhus", '{"wspd": 1}'), (t, "Aarhus", "garbage")],
                              "timestamp timestamp_ntz, municipality string, weather_data string")
    obs = station_property(w, "timestamp", "municipality", "weather_data", "temp")
    out = rows(property_day_zscore(obs, "timestamp", prop="temp"))
    assert all(r["day_sum"] == 0.0 for r in out)
    assert out[0]["palette"] == "thermal"
    assert out[0]["text"] == ("<br>Municipality Center for Weather Data Collection: Aarhus<br>Weather Property: "
                              "temp<br>Sum of temp for the Selected Day: 0.00<br>Selected Day: 2022-01-02")


def test_weather_materialized_same_result(spark):
    t = [dt.datetime(2022, 1, 2, h) for h in range(4)]
    w = spark.createDataFrame([(t[i], "Aarhus", f'{{"temp": {i * 1.5}}}') for i in range(4)],
                              "timestamp timestamp_ntz, municipality string, weather_data string")
    obs = station_property(w, "timestamp", "municipality", "weather_data", "temp")
    a = rows(property_day_zscore(obs, "timestamp", prop="temp"), "timestamp")
    b = rows(property_day_zscore(obs, "timestamp", prop="temp", materialize=True), "timestamp")
    assert a == b and len(a) == 4


def test_enabled_stations_as_a_frame(spark):
    from gridpulse.sources.dims import names_frame
    t = dt.datetime(2022, 1, 2, 1)
    w = spark.createDataFrame([(t, "Copenhagen", '{"temp": 1}'), (t, "Vejle", '{"temp": 2}')],
                              "timestamp timestamp_ntz, municipality string, weather_data string")
    obs = station_property(w, "timestamp", "municipality", "weather_data", "temp")
    by_list = rows(property_day_zscore(obs, "timestamp", enabled=ENABLED_MUNICIPALITIES))
    by_frame = rows(property_day_zscore(obs, "timestamp", enabled=names_frame(spark, ENABLED_MUNICIPALITIES)))
    assert by_list == by_frame and [r["municipality"] for r in by_list] == ["København"]
