"""The whole dashboard flow on domain-shaped tables, with the domain names."""

import datetime as dt

from pyspark.sql import functions as F

from gridpulse.operators import exchange as X
from gridpulse.operators import weather as W
from gridpulse.plans import dashboard as Q
from gridpulse.sources.dims import ENABLED_MUNICIPALITIES, trade_roles_frame
from gridpulse.sources.readers import typed_consumption, typed_prodcon, typed_production
from test_dashboard import _munis, _production, _weather


def test_every_view_runs_on_domain_tables(spark):
    weather = Q.clean_weather(_weather(spark))
    profile = Q.municipality_profile(_munis(spark), weather)
    prod = Q.clean_hourly(_production(spark).filter(F.col("hour_utc").isNotNull()),
                          ["municipality_number"], "hour_utc", ["solar_power_mwh", "onshore_wind_power_mwh"])
    h = [dt.datetime(2022, 1, 2, i) for i in range(3)]
    cons = typed_consumption(spark.createDataFrame(
        [(str(h[0]), 101, "Privat", 2.0), (str(h[1]), 101, "Privat", None), (str(h[2]), 751, "Erhverv", 7.0)],
        "hour_utc string, municipality_number int, industry_groups string, consumption_kwh double"))
    pc = typed_prodcon(spark.createDataFrame(
        [(str(h[0]), "DK1", -1.0, 2.0, None, 0.0), (str(h[1]), "DK2", 3.0, -4.0, None, 0.0)],
        "hour_utc string, price_area string, exchangegb_mwh double, exchangege_mwh double, "
        "exchangenl_mwh double, exchangeno_mwh double"))
    countries, roles = X.country_dim(spark), trade_roles_frame(spark)
    obs = W.station_property(weather, "timestamp", F.col("municipality"), "weather_data", "temp")
    views = {
        "production": Q.production_map(prod, profile, "2022-01-02", "solar_power_mwh"),
        "consumption": Q.consumption_map(cons, profile, "2022-01-02", "Privat"),
        "zones": X.zone_summaries(X.zone_country_exchange(pc, countries, "2022-01-02"), roles, "2022-01-02"),
        "neighbours": X.neighbour_utilisation(pc, countries, "2022-01-02", coords=roles),
        "literal": X.neighbour_trade_literal(pc, roles, "2022-01-02"),
        "weather": W.property_day_zscore(obs, "timestamp", enabled=ENABLED_MUNICIPALITIES,
                                         day="2022-01-01", prop="temp"),
        "production_series": Q.hourly_series(prod, ["municipality_number"], "hour_utc", "solar_power_mwh",
                                             selected=Q.selected_hour(2)),
        "consumption_series": Q.hourly_series(cons, ["municipality_number", "industry_groups"], "hour_utc",
                                              "consumption_kwh"),
        "zone_share": X.zone_share(pc, countries, "2022-01-02"),
        "country_share": X.country_share(pc, countries, "2022-01-02"),
        "net": X.net_locations(pc, countries, "2022-01-02"),
        "calendar": Q.calendar_marks(prod, "hour_utc"),
    }
    counts = {k: v.count() for k, v in views.items()}
    assert counts["production"] == 3 and counts["consumption"] == 3
    assert counts["zones"] == 2 and counts["neighbours"] == 4 and counts["literal"] == 4
    assert counts["weather"] == 4 and counts["zone_share"] == 16 and counts["country_share"] == 8
    assert counts["net"] == 2 and counts["calendar"] == 1
    assert counts["production_series"] == 4 and counts["consumption_series"] == 3
