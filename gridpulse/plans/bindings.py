"""``queries()``: every operator family bound to the driver's test tables.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole tables (see ``standins`` for how they play the energy tables).
Float outputs are rounded to 4 decimals and money sums stay DECIMAL until
the end, so results compare exactly with the SQL oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.scalars import day_number_to_date, first_set, floor_ntz, fmt2
from gridpulse.operators.aggregate import day_totals, zero_filled
from gridpulse.operators import select
from gridpulse.operators.clean import null_profile, replace_values, to_kwh
from gridpulse.operators.exchange import (country_dim, daily_cumulative, neighbour_trade_literal,
                                          neighbour_utilisation,
                                          net_locations, zone_country_exchange, zone_share,
                                          country_share, zone_summaries)
from gridpulse.operators.joins import left_join_keep_first, reverse_lookup, semi_join_values, series_with_hour
from gridpulse.operators.scale import group_rescale
from gridpulse.operators.series import smooth
from gridpulse.operators.weather import property_day_zscore, station_property
from gridpulse.plans import dashboard as Q
from gridpulse.plans import standins as S
from gridpulse.operators.spatial import any_box_exists, locate_points, points_in_boxes
from gridpulse.sources.dims import CLOSED_BOUNDS, PRODUCTION_COLUMNS, bounds_frame, trade_roles_frame
from gridpulse.session import scratch_path
from gridpulse.sources.readers import (normalise_columns, read_documents, read_table, save_hourly, split_documents, typed_consumption,
                                       typed_municipalities, typed_prodcon, typed_production, typed_weather)

__all__ = ["QUERIES"]


def r4(c) -> F.Column:
    """Round to 4 decimals as ``round(x * 1e4) / 1e4`` (ties like the oracle),
    with -0.0 folded to 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(10000.0)) / F.lit(10000.0) + F.lit(0.0)


def _ev(spark, sf):
    return S.table(spark, sf, "events")


def _countries(spark):
    return country_dim(spark)


# --- Q14: clean load ---------------------------------------------------------

def clean_load(spark: SparkSession, sf: str) -> DataFrame:
    """Q14: FLT1, FLT2, DT1 (NULL text dropped, strict parse, closed window)."""
    w = S.weather_observations(_ev(spark, sf))
    out = Q.clean_weather(w, S.CLEAN_LO, S.CLEAN_HI)
    return out.select("event_id", F.col("timestamp").alias("ts"), "municipality", r4("value").alias("value"))


MEASURES = S.EVENT_TYPES


def impute_series(spark: SparkSession, sf: str) -> DataFrame:
    """Q14: IMP1-IMP4, WIN7 on the hourly production table, day chunks."""
    prod = S.hourly_production(_ev(spark, sf))
    prod = prod.select("hour_utc", "municipality_number",
                       *[F.col(m).cast("double").alias(m) for m in MEASURES])
    # day chunks (the library default is month): the test tables span one
    # month, and day chunks make the oracle check cover carries across chunks
    out = Q.clean_hourly(prod, ["municipality_number"], "hour_utc", MEASURES, chunk_unit="day")
    return out.select("hour_utc", "municipality_number", *[r4(m).alias(m) for m in MEASURES])


def null_profile_q(spark: SparkSession, sf: str) -> DataFrame:
    """IMP5, IMP6, FLT10: NULL counts before imputation, sums with NULL as 0."""
    prod = S.hourly_production(_ev(spark, sf))
    out = null_profile(prod, MEASURES)
    return out.select("measure", "n_rows", "n_null", "n_non_null", r4("sum_filled").alias("sum_filled"))


# --- Q1: dimension with station distance and label ---------------------------

CUSTOMER_LABEL = [("", "c_name"), ("Nation: ", "c_nationkey"), ("Segment: ", "c_mktsegment"),
                  ("Balance: ", "acctbal_text")]


def dim_with_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Q1: AGG1, JN1, PRJ4, STR2 (first station distance, collision-safe join, label)."""
    cust = S.table(spark, sf, "customer").withColumn("acctbal_text", fmt2("c_acctbal"))
    obs = S.weather_observations(_ev(spark, sf)).withColumnRenamed("user_id", "c_custkey")
    out = Q.municipality_profile(cust, obs, key="c_custkey", weather_key="c_custkey",
                                 order=("ts", "event_id"), label=CUSTOMER_LABEL, aliases={})
    # the label shows the distance with two decimals
    return out.select("c_custkey", "c_name", "c_nationkey", r4("c_acctbal").alias("c_acctbal"),
                      "c_mktsegment", r4("distance_to_station_km").alias("distance_to_station_km"),
                      "hover_text")


# --- Q2 / Q3 and their parts -------------------------------------------------

def entity_day_total(spark: SparkSession, sf: str) -> DataFrame:
    """FLT4, FLT5, AGG2, JN2, PRJ2, PRJ5: every dimension row with its day total."""
    prod = S.hourly_production(_ev(spark, sf), day=S.DAY)
    totals = day_totals(prod, ["municipality_number"], "hour_utc", "click", S.DAY, out="total_mwh")
    cust = S.table(spark, sf, "customer").select("c_custkey")
    out = zero_filled(cust, "c_custkey", totals, "municipality_number", ["total_mwh"])
    return out.select("c_custkey", r4("total_mwh").alias("total_mwh"),
                      r4(to_kwh("total_mwh")).alias("total_kwh"))


def entity_group_day_total(spark: SparkSession, sf: str) -> DataFrame:
    """FLT6, AGG3: day totals of one industry group, zero-filled."""
    cons = S.hourly_consumption(_ev(spark, sf), day=S.DAY)
    rows = cons.filter(F.col("industry_groups") == "purchase")
    totals = day_totals(rows, ["municipality_number"], "hour_utc", "consumption_kwh", S.DAY,
                        out="total_kwh")
    cust = S.table(spark, sf, "customer").select("c_custkey")
    out = zero_filled(cust, "c_custkey", totals, "municipality_number", ["total_kwh"])
    return out.select("c_custkey", F.lit("purchase").alias("industry_group"),
                      r4("total_kwh").alias("total_kwh"))


def production_map(spark: SparkSession, sf: str) -> DataFrame:
    """Q2: MTH1, WIN1, ARR1, MTH5, STR3, DT6b (size, running scale, colour, label)."""
    prod = S.hourly_production(_ev(spark, sf), day=S.DAY)
    cust = S.table(spark, sf, "customer")
    out = Q.production_map(prod, cust, S.DAY, "click", dim_key="c_custkey", dim_label="c_name")
    return out.select("code", r4("total_mwh").alias("total_mwh"), r4("total_kwh").alias("total_kwh"),
                      r4("size").alias("size"), r4("scale").alias("scale"), "color_index",
                      "palette", "text")


def consumption_map(spark: SparkSession, sf: str) -> DataFrame:
    """Q3: WIN2 (scale onto [0.3, 1]) with the consumption label."""
    cons = S.hourly_consumption(_ev(spark, sf), day=S.DAY)
    cust = S.table(spark, sf, "customer")
    out = Q.consumption_map(cons, cust, S.DAY, group="purchase", dim_key="c_custkey",
                            dim_label="c_name")
    return out.select("code", r4("total_kwh").alias("total_kwh"), r4("size").alias("size"),
                      r4("scale").alias("scale"), "color_index", "palette", "text")


# --- Q4, Q5, Q10-Q12: exchange -----------------------------------------------

def _prodcon(spark, sf, day=None, to=None):
    return S.hourly_prodcon(_ev(spark, sf), day, to)


def zone_exchange(spark: SparkSession, sf: str) -> DataFrame:
    """Q4: FLT3, FLT8, JN5, AGG5, STR3 (zone x country day import/export)."""
    z = zone_country_exchange(_prodcon(spark, sf, day=S.DAY), _countries(spark), S.DAY)
    return z.select("price_area", "country", r4("import_mwh").alias("import_mwh"),
                    r4("export_mwh").alias("export_mwh"), "text")


def neighbour_util(spark: SparkSession, sf: str) -> DataFrame:
    """Q5: AGG6-AGG8, AGG14, CND2, MTH2 (cumulative trade, use, level, size, label)."""
    n = neighbour_utilisation(_prodcon(spark, sf, to=S.YEAR_END), _countries(spark), S.SLIDER_DAY, S.YEAR_END,
                              coords=trade_roles_frame(spark))
    num = ["day_import", "day_export", "day_net", "cum_import", "cum_export", "year_import",
           "year_export", "current_use", "yearly_max", "size"]
    return n.select("country", *[r4(c).alias(c) for c in num], "level", "text")


def neighbour_trade_literal_q(spark: SparkSession, sf: str) -> DataFrame:
    """Q5 with the role columns taken literally (swapped roles)."""
    n = neighbour_trade_literal(_prodcon(spark, sf, to=S.YEAR_END), trade_roles_frame(spark), S.SLIDER_DAY, S.YEAR_END)
    num = ["day_export", "cum_export", "year_export", "day_import", "cum_import", "year_import",
           "current_use", "yearly_max", "size"]
    return n.select("country", "lat", "lon", *[r4(c).alias(c) for c in num], "level")


def zone_dots(spark: SparkSession, sf: str) -> DataFrame:
    """SET1, STR4: zone markers (joined per-country texts) and neighbour markers in one list."""
    countries, roles = _countries(spark), trade_roles_frame(spark)
    zones = zone_summaries(zone_country_exchange(_prodcon(spark, sf, day=S.DAY), countries, S.DAY), roles, S.DAY)
    neigh = neighbour_utilisation(_prodcon(spark, sf, to=S.YEAR_END), countries, S.SLIDER_DAY, S.YEAR_END, coords=roles)
    neigh = neigh.join(F.broadcast(roles.select(F.col("name").alias("country"),
                                                F.col("lat").alias("r_lat"),
                                                F.col("lon").alias("r_lon"))), "country")
    neigh = neigh.select(F.col("country").alias("name"), F.col("r_lat").alias("lat"),
                         F.col("r_lon").alias("lon"), "text", r4("size").alias("size"), "level")
    return zones.unionByName(neigh, allowMissingColumns=True)


def cumulative_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """WIN6, FLT7: daily and running import/export per country for every day."""
    d = daily_cumulative(_prodcon(spark, sf), _countries(spark))
    return d.select("country", "day", *[r4(c).alias(c) for c in
                                        ["day_import", "day_export", "cum_import", "cum_export"]])


def zone_share_q(spark: SparkSession, sf: str) -> DataFrame:
    """Q10: AGG15 (import vs export share per zone and country)."""
    z = zone_share(_prodcon(spark, sf, day=S.DAY), _countries(spark), S.DAY)
    return z.select("price_area", "country", "direction", "label", r4("mwh").alias("mwh"),
                    r4("share").alias("share"))


def country_share_q(spark: SparkSession, sf: str) -> DataFrame:
    """Q11: AGG9, AGG15 (cumulative share per country)."""
    c = country_share(_prodcon(spark, sf, to=S.SLIDER_DAY), _countries(spark), S.SLIDER_DAY)
    return c.select("country", "direction", "label", r4("mwh").alias("mwh"),
                    r4("share").alias("share"))


def net_locations_q(spark: SparkSession, sf: str) -> DataFrame:
    """Q12: AGG4, JN3, FLT9, SRC8 (countries with non-zero net exchange)."""
    n = net_locations(_prodcon(spark, sf, day=S.DAY), _countries(spark), S.DAY)
    return n.select("name", "lat", "lon", r4("value").alias("value"))


# --- Q6: weather property z-scores --------------------------------------------

def json_property_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """Q6: JSN1-JSN3, JN9, AGG11-AGG13, WIN3, WIN4, MTH4, CND3 (weather map)."""
    w = S.weather_observations(_ev(spark, sf))
    obs = station_property(w, "ts", "municipality", "weather_data", "k",
                           aliases=S.STATION_ALIASES, keep=["event_id"])
    out = property_day_zscore(obs, "ts", enabled=S.ENABLED_STATIONS, prop="k")
    return out.select("event_id", "municipality", "ts", "day", "value", r4("day_sum").alias("day_sum"),
                      r4("mean").alias("mean"), r4("std").alias("std"), r4("z_size").alias("z_size"),
                      r4("scale").alias("scale"), "color_index", "text")


def weather_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSN1-JSN3, IMP7, STR5, PRJ6: the station and a property out of strict documents,
    with and without a default, and whether the key is there."""
    w = S.weather_documents(_ev(spark, sf))
    obs = station_property(w, "ts", None, "weather_data", "temp", aliases=S.STATION_ALIASES, keep=["event_id"],
                           station_key="municipality", has_out="has_key")
    zero = station_property(w, "ts", None, "weather_data", "temp", default=0.0, keep=["event_id"], station_key="municipality",
                            value_out="value_or_zero").select("event_id", "value_or_zero")
    return obs.join(zero, "event_id").select("event_id", "municipality", r4("value").alias("value"), r4("value_or_zero").alias("value_or_zero"),
                                             "has_key")


# --- Q7-Q9: smoothing ---------------------------------------------------------

def smooth_series(spark: SparkSession, sf: str) -> DataFrame:
    """Q7-Q9: SIG1-SIG4, WIN5, ORD1, FLT11, DT6 (hourly series, smoothed)."""
    series = S.hourly_by_type(_ev(spark, sf))
    out = Q.hourly_series(series, ["event_type"], "hour_utc", "value", selected=S.SELECTED_HOUR,
                          max_points=Q.HOURS_OF_A_YEAR)
    return out.select("event_type", "hour_utc", "iso", r4("raw").alias("raw"),
                      r4("smoothed").alias("smoothed"), "is_selected")


def smooth_long_series(spark: SparkSession, sf: str) -> DataFrame:
    """SIG1-SIG4 on series longer than a cell: every event is a point, cells of
    1,024 points, so that the transforms go through their exchanges."""
    events = _ev(spark, sf).select("event_type", "ts", "event_id", "value")
    out = smooth(events, ["event_type"], ["ts", "event_id"], "value", keep_ratio=0.01, chunk=floor_ntz("ts", "day"), points=1024)
    return out.select("event_type", "event_id", "pos", "n_points", r4("smoothed").alias("smoothed"))


def production_series(spark: SparkSession, sf: str) -> DataFrame:
    """Q7: JN4, FLT5, IMP5, FLT11, SIG4 (series picked by name, NULL as 0, smoothed).

    The names are those of all customers, resolved to codes through the
    dimension."""
    prod = S.hourly_production(_ev(spark, sf))
    cust = S.table(spark, sf, "customer")
    names = cust.select(F.col("c_name").alias("name"))
    out = Q.hourly_series(prod, ["municipality_number"], "hour_utc", "click",
                          selected=S.SELECTED_HOUR, max_points=Q.HOURS_OF_A_YEAR,
                          names=names, name_col="name", dim=cust, dim_name="c_name",
                          dim_code="c_custkey")
    return out.select("municipality_number", "hour_utc", r4("raw").alias("raw"),
                      r4("smoothed").alias("smoothed"), "is_selected")


def consumption_series(spark: SparkSession, sf: str) -> DataFrame:
    """Q9: one municipality (by name, through the dimension) and each of its
    industry groups, raw and smoothed."""
    series = S.hourly_area_consumption(_ev(spark, sf))
    dim = spark.createDataFrame(S.AREAS, "code int, area string")
    names = spark.createDataFrame([("DK1",), ("nowhere",)], "name string")
    out = Q.hourly_series(series, ["industry_groups", "municipality_number"], "hour_utc", "consumption_kwh",
                          selected=S.SELECTED_HOUR, max_points=Q.HOURS_OF_A_YEAR, names=names, name_col="name",
                          dim=dim, dim_name="area", dim_code="code", names_key="municipality_number")
    return out.select("municipality_number", "industry_groups", "hour_utc", r4("raw").alias("raw"),
                      r4("smoothed").alias("smoothed"), "is_selected")


def typed_load(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1, DT2, IMP5: text times to the UTC wall clock, text codes, NaN as NULL."""
    out = typed_production(S.raw_hours(_ev(spark, sf)), keep=["event_id"])
    return out.select("event_id", "hour_utc", "municipality_number",
                      *[r4(c).alias(c) for c in PRODUCTION_COLUMNS])


def production_map_wind(spark: SparkSession, sf: str) -> DataFrame:
    """Q2, CND3, ARR1: a measure whose palette has seven steps."""
    prod = S.hourly_production(_ev(spark, sf), day=S.DAY).withColumnRenamed("view", "onshore_wind_power_mwh")
    out = Q.production_map(prod, S.table(spark, sf, "customer"), S.DAY, "onshore_wind_power_mwh", dim_key="c_custkey",
                           dim_label="c_name")
    return out.select("code", r4("total_mwh").alias("total_mwh"), r4("scale").alias("scale"), "color_index", "palette")


def weather_series(spark: SparkSession, sf: str) -> DataFrame:
    """Q8: JSN2, IMP7, SIG4 (a JSON property per station, 0 for a missing key, smoothed).

    Weather rows are hourly; here the events of an hour are averaged."""
    w = S.weather_observations(_ev(spark, sf))
    obs = station_property(w, "ts", "municipality", "weather_data", "k", default=0.0,
                           aliases=S.STATION_ALIASES)
    hourly = obs.groupBy("municipality", floor_ntz("ts", "hour").alias("hour_utc")) \
                .agg(F.avg("value").alias("value"))
    out = Q.hourly_series(hourly, ["municipality"], "hour_utc", "value", max_points=Q.HOURS_OF_A_YEAR)
    return out.select("municipality", "hour_utc", r4("raw").alias("raw"),
                      r4("smoothed").alias("smoothed"))


# --- Q13: region matching -------------------------------------------------------

def region_points(spark: SparkSession, sf: str) -> DataFrame:
    """Q13: JN6, JN7, SRC10 (region of each point, validity)."""
    pts = S.event_points(_ev(spark, sf))
    out = Q.region_points(pts)
    return out.select("point_id", r4("lon").alias("lon"), r4("lat").alias("lat"), "region", "is_valid")


def region_valid_join(spark: SparkSession, sf: str) -> DataFrame:
    """JN6, SRC10: boxes as a frame, an existence join against the broadcast bounds.

    One output row per point, no shuffle."""
    pts = S.event_points(_ev(spark, sf))
    out = any_box_exists(pts, F.broadcast(bounds_frame(spark, CLOSED_BOUNDS)))  # six fixed boxes
    return out.select("point_id", "is_valid")


def points_in_many_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """JN6 with a frame of boxes from the data: totals of the points in each box,
    through the quad-tree cover, without a row for every match."""
    boxes_ = S.customer_boxes(S.table(spark, sf, "customer"))
    found = points_in_boxes(S.event_points(_ev(spark, sf)), boxes_, totals="point_id")
    return found.select("location", "n_points", "first_point", r4("max_lon").alias("max_lon"), r4("min_lat").alias("min_lat"))


def region_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """JN7, JN6 from a frame: the box of the least priority that holds each point
    (open bounds), and whether there is one."""
    out = locate_points(S.event_points(_ev(spark, sf)), S.customer_boxes(S.table(spark, sf, "customer")))
    return out.select("point_id", "region", "is_valid")


# --- Q15: calendar ----------------------------------------------------------------

def calendar_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Q15: DT4, DT7 (day dimension of the data with labels)."""
    return Q.calendar_marks(_ev(spark, sf), "ts")


# --- name lookup, first rows ----------------------------------------------------------

NATION_ALIASES = {"NATION_1": "NATION_ONE"}


def name_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """JN4, PRJ6, PRJ7, SRC7 (whole-value aliases, distinct names, reverse lookup)."""
    cust = S.table(spark, sf, "customer")
    nation = S.table(spark, sf, "nation")
    named = cust.join(nation.select("n_nationkey", "n_name"),
                      cust["c_nationkey"] == nation["n_nationkey"])
    names = (replace_values(named.select(F.col("n_name").alias("name")), "name", NATION_ALIASES)
                  .groupBy("name").agg(F.count(F.lit(1)).alias("n_customers")))
    out = reverse_lookup(names, "name", nation, "n_name", "n_nationkey", out="code")
    return out.select("name", "code", "n_customers")


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """ORD2, SNK2: the first 98 rows in key order (a top-k)."""
    o = S.table(spark, sf, "orders")
    return select.first_rows(o, "o_orderkey", 98).select("o_orderkey", "o_custkey", "o_orderdate",
                                                    r4("o_totalprice").alias("o_totalprice"))


# --- sources: documents and catalog tables ----------------------------------------------

def document_load(spark: SparkSession, sf: str) -> DataFrame:
    """SRC6, PRJ1, PRJ3, STR1: documents written as lines, read with a fixed schema;
    good rows typed, spoiled lines kept as text."""
    path = scratch_path(spark, "documents")
    S.municipality_lines(S.table(spark, sf, "customer")).write.text(path)
    good, bad = split_documents(read_documents(spark, path, corrupt="_bad"), "_bad")
    good = normalise_columns(typed_municipalities(good))
    cols = ["lau_1_code_1", "municipality", "region", "total_area_km2", "latitude", "powerregion"]
    good = good.withColumnRenamed("power_region", "powerregion").select(*cols, F.lit(None).cast("string").alias("text"))
    bad = bad.select(*[F.lit(None).cast(good.schema[c].dataType).alias(c) for c in cols], F.col("_bad").alias("text"))
    return good.unionByName(bad)


def typed_loads(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2-SRC4, DT2, IMP5: consumption from CSV, exchange from ORC and weather from a
    Parquet catalog table, through their typed loaders."""
    raw = S.raw_tables(_ev(spark, sf))
    paths = {name: scratch_path(spark, name) for name in raw}
    raw["consumption"].write.option("header", "true").csv(paths["consumption"])
    raw["prodcon"].write.orc(paths["prodcon"])
    name = f"gp_weather_{uuid.uuid4().hex[:8]}"
    raw["weather"].write.option("path", paths["weather"]).saveAsTable(name)
    cons = typed_consumption(read_table(spark, paths["consumption"], "csv", options={"header": "true"}, schema=raw["consumption"].schema))
    prod = typed_prodcon(read_table(spark, paths["prodcon"], "orc"))
    weather = typed_weather(read_table(spark, table=name))
    none = F.lit(None)
    return (cons.select(F.lit("consumption").alias("kind"), F.col("hour_utc").alias("at"), none.cast("string").alias("text_at"),
                        F.col("industry_groups").alias("name"), F.col("municipality_number").alias("code"), r4("consumption_kwh").alias("value"))
            .unionAll(prod.select(F.lit("prodcon"), "hour_utc", none.cast("string"), "price_area", none.cast("int"),
                                  r4(F.col("exchangegb_mwh") + F.col("exchangeno_mwh"))))
            .unionAll(weather.select(F.lit("weather"), none.cast("timestamp_ntz"), "timestamp", "municipality", none.cast("int"),
                                     r4("distance_to_station_km"))))


def catalog_totals(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1, SRC5, JN2, AGG2 over catalog tables: production by month and bucket, the
    dimension by bucket; the months come from a calendar."""
    tag = uuid.uuid4().hex[:8]
    hourly = S.hourly_production(_ev(spark, sf)).select("hour_utc", "municipality_number", "click")
    prod = save_hourly(hourly, f"gp_production_{tag}", scratch_path(spark, "production"), "municipality_number", "hour_utc", buckets=8)
    dim = save_hourly(S.table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("municipality_number"), "c_name"),
                      f"gp_dimension_{tag}", scratch_path(spark, "dimension"), "municipality_number", buckets=8)
    return catalog_plan(spark, prod, dim)


def catalog_plan(spark: SparkSession, prod: DataFrame, dim: DataFrame, quarter: int = 1) -> DataFrame:
    """Totals of one quarter for every row of the dimension."""
    months = spark.createDataFrame([(f"2024-{m:02d}", (m + 2) // 3) for m in range(1, 13)], "cal_month string, quarter int")
    rows = prod.join(F.broadcast(months.where(F.col("quarter") == quarter)), F.col("month") == F.col("cal_month"))
    totals = rows.groupBy("municipality_number").agg(F.sum("click").alias("total_mwh"), F.count("click").alias("n_hours"))
    out = zero_filled(dim, "municipality_number", totals, "municipality_number", ["total_mwh", "n_hours"])
    return out.select("municipality_number", "c_name", r4("total_mwh").alias("total_mwh"), "n_hours")


def series_at_hour(spark: SparkSession, sf: str) -> DataFrame:
    """FLT11, JN9, JN4: rows of the series that have the selected hour, of stations
    named in a frame."""
    hourly = S.hourly_production(_ev(spark, sf))
    some = series_with_hour(hourly.select("hour_utc", "municipality_number", "click", "view"), ["municipality_number"], "hour_utc", S.SELECTED_HOUR)
    named = S.table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select("c_custkey")
    out = semi_join_values(some, "municipality_number", named, "c_custkey")
    return out.select("hour_utc", "municipality_number", r4("click").alias("click"), r4("view").alias("view"))


def slider_views(spark: SparkSession, sf: str) -> DataFrame:
    """DT4, DT5, CND1, PRJ4, AGG7, AGG8, WIN3, FLT12: every day of the slider with its date,
    the view that is active, the trade to the day and to a year end inside the data,
    scaled over all rows; a fallback column of a colliding name."""
    marks = Q.calendar_marks(_ev(spark, sf), "ts").select("day_number")
    marks = marks.select("day_number", day_number_to_date("day_number", S.BASE_DAY).alias("day"), day_number_to_date(F.col("day_number") + 1, S.BASE_DAY).alias("map_day"))
    daily = daily_cumulative(_prodcon(spark, sf), _countries(spark)).where("country = 'Norway'").select("day", "cum_import", "day_import")
    end = _prodcon(spark, sf).where(F.to_date("hour_utc") <= F.lit(S.SHORT_YEAR_END)).agg(F.sum(F.least("exchangeno_mwh", F.lit(0))).alias("year_import"))
    out = left_join_keep_first(marks.withColumn("cum_import", F.when(F.col("day_number") % 2 == 0, F.lit(0).cast("decimal(38,2)"))), daily, "day", fill_from_right=True)
    out = out.join(F.broadcast(end))  # one row
    out = group_rescale(out.withColumn("size", F.abs("day_import").cast("double")), [], "size", out="scale", out_lo=0.3, out_hi=1.0)
    none = out.where(F.lit(False))  # an empty selection keeps the schema
    out = out.unionByName(none)
    mode = first_set([(F.col("day_number") % 3 == 0, "production"), (F.col("day_number") % 3 == 1, "consumption")], "import_export")
    return out.select("day_number", "day", "map_day", mode.alias("active_mode"), r4("cum_import").alias("cum_import"),
                      r4("year_import").alias("year_import"), r4("scale").alias("scale"))


def first_order(spark: SparkSession, sf: str) -> DataFrame:
    """ORD3: each customer's first order by date, then key."""
    o = S.table(spark, sf, "orders")
    f = select.first_match(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey")
    return f.select("o_custkey", "o_orderkey")


QUERIES = {
    "clean_load": clean_load,
    "impute_series": impute_series,
    "null_profile": null_profile_q,
    "dim_with_distance": dim_with_distance,
    "entity_day_total": entity_day_total,
    "entity_group_day_total": entity_group_day_total,
    "production_map": production_map,
    "consumption_map": consumption_map,
    "zone_exchange": zone_exchange,
    "zone_dots": zone_dots,
    "neighbour_trade_literal": neighbour_trade_literal_q,
    "neighbour_utilisation": neighbour_util,
    "cumulative_by_day": cumulative_by_day,
    "zone_share": zone_share_q,
    "country_share": country_share_q,
    "net_locations": net_locations_q,
    "json_property_zscore": json_property_zscore,
    "weather_documents": weather_documents,
    "smooth_series": smooth_series,
    "smooth_long_series": smooth_long_series,
    "production_series": production_series,
    "consumption_series": consumption_series,
    "typed_load": typed_load,
    "production_map_wind": production_map_wind,
    "weather_series": weather_series,
    "region_points": region_points,
    "region_valid_join": region_valid_join,
    "points_in_many_boxes": points_in_many_boxes,
    "region_by_priority": region_by_priority,
    "calendar_marks": calendar_marks,
    "name_lookup": name_lookup,
    "document_load": document_load,
    "typed_loads": typed_loads,
    "catalog_totals": catalog_totals,
    "series_at_hour": series_at_hour,
    "slider_views": slider_views,
    "first_rows": first_rows,
    "first_order": first_order,
}
