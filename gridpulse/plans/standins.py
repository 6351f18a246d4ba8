"""How the driver's test tables stand in for the energy tables.

The test data has no energy tables, so the hourly tables are derived from
``events`` by Spark (they grow with it):

* production: hourly sums of ``value`` per ``user_id`` (the municipality), one
  column per ``event_type`` (the five event types play the five measures);
* consumption: hourly sums per (user, event type as industry group);
* prodcon: hourly sums per price area (``DK1`` for even user ids, ``DK2`` for
  odd) of ``value - 40`` (signed), one column per exchange (four event types);
* weather: one observation per event: a text timestamp, the event type as the
  station, the ``props`` JSON as the weather document, ``value`` as the
  station distance (NULL on ``error`` events).

Some rows are spoiled by content, via the JSON number ``k`` in ``props``:
k = 0 loses its timestamp text, k = 1 gets unparsable text, k = 2 gets
truncated JSON and k = 3 a non-numeric property. ``customer`` stands in for
the municipality dimension (``c_custkey`` = ``user_id``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.sources.dims import PRODUCTION_COLUMNS
from gridpulse.functions.scalars import floor_ntz, on_day, up_to_day, wall_clock_text

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EXCHANGE_BY_TYPE = {"click": "exchangegb_mwh", "purchase": "exchangege_mwh",
                    "signup": "exchangenl_mwh", "view": "exchangeno_mwh"}
STATION_ALIASES = {"view": "pageview"}
ENABLED_STATIONS = ["click", "purchase", "signup", "pageview"]
MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def k_of(props: str = "props"):
    """The number ``k`` of the JSON document."""
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def _window(ev: DataFrame, day) -> DataFrame:
    return ev if day is None else ev.filter(on_day("ts", day))


def hourly_production(ev: DataFrame, day=None) -> DataFrame:
    """(hour_utc, municipality_number, click, error, purchase, signup, view)."""
    ev = _window(ev, day)
    return (ev.groupBy(floor_ntz("ts", "hour").alias("hour_utc"),
                       F.col("user_id").alias("municipality_number"))
              .agg(*_wide_sums(F.col("value").cast(MONEY), {t: t for t in EVENT_TYPES})))


def _wide_sums(value, names: dict):
    """One column per event type as conditional sums: a single aggregation
    (``pivot`` would add a second aggregate and a second shuffle)."""
    return [F.sum(F.when(F.col("event_type") == F.lit(t), value)).alias(c) for t, c in names.items()]


def hourly_consumption(ev: DataFrame, day=None) -> DataFrame:
    """(hour_utc, municipality_number, industry_groups = event type, consumption_kwh)."""
    ev = _window(ev, day)
    return (ev.groupBy(floor_ntz("ts", "hour").alias("hour_utc"),
                       F.col("user_id").alias("municipality_number"),
                       F.col("event_type").alias("industry_groups"))
              .agg(F.sum(F.col("value").cast(MONEY)).alias("consumption_kwh")))


def price_area():
    """DK1 for even user ids, DK2 for odd ones."""
    return F.when(F.col("user_id") % 2 == 0, F.lit("DK1")).otherwise(F.lit("DK2"))


def hourly_prodcon(ev: DataFrame, day=None, to=None) -> DataFrame:
    """(hour_utc, price_area, four signed exchange columns), of one day or of
    all days to ``to`` if given."""
    types = list(EXCHANGE_BY_TYPE)
    ev = _window(ev, day)
    if to is not None:
        ev = ev.filter(up_to_day("ts", to))
    return (ev.filter(F.col("event_type").isin(types))
              .groupBy(floor_ntz("ts", "hour").alias("hour_utc"), price_area().alias("price_area"))
              .agg(*_wide_sums(F.col("value").cast(MONEY) - F.lit(40), EXCHANGE_BY_TYPE)))


def weather_observations(ev: DataFrame) -> DataFrame:
    # k is projected once and referenced by name: an expensive expression
    # referenced several times is then evaluated once per row
    """One weather row per event: text timestamp, station, distance, JSON document."""
    ev = ev.select("event_id", "ts", "user_id", "value", "event_type", "props", k_of().alias("_k"))
    k = F.col("_k")
    text = (F.when(k == 0, F.lit(None).cast("string"))
             .when(k == 1, F.lit("not-a-time"))
             .otherwise(wall_clock_text("ts")))
    doc = (F.when(k == 2, F.expr("substring(props, 1, length(props) - 1)"))
            .when(k == 3, F.lit('{"k": "n/a"}'))
            .otherwise(F.col("props")))
    distance = F.when(F.col("event_type") != "error", F.col("value"))
    return ev.select("event_id", "ts", "user_id", "value", "event_type",
                     text.alias("timestamp"), F.col("event_type").alias("municipality"),
                     distance.alias("distance_to_station_km"), doc.alias("weather_data"))


def weather_documents(ev: DataFrame) -> DataFrame:
    """Weather rows whose station stands in the document only. By ``k`` some are
    spoiled: 0 has text behind the object, 1 repeats the key (the last counts), 2
    lacks it, 3 is cut short, 4 is a list, 5 holds null, 6 a number as text, 7 a
    second object, 8 a closing bracket and text."""
    ev = ev.select("event_id", "ts", "event_type", "value", k_of().alias("_k"))
    k, head = F.col("_k"), F.concat(F.lit('{"municipality": "'), F.col("event_type"), F.lit('", '))
    number = F.round(F.col("value"), 2).cast("string")
    temp = F.concat(F.lit('"temp": '), number)
    text = F.concat(head, temp, F.lit("}"))
    doc = (F.when(k == 0, F.concat(text, F.lit(" junk"))).when(k == 1, F.concat(head, F.lit('"temp": 1.5, '), temp, F.lit("}")))
            .when(k == 2, F.concat(head, F.lit('"dwpt": '), number, F.lit("}"))).when(k == 3, F.concat(head, temp))
            .when(k == 4, F.concat(F.lit("["), number, F.lit("]"))).when(k == 5, F.concat(head, F.lit('"temp": null}')))
            .when(k == 6, F.concat(head, F.lit('"temp": "'), number, F.lit('"}'))).when(k == 7, F.concat(text, text))
            .when(k == 8, F.concat(text, F.lit("] x"))).otherwise(text))
    return ev.select("event_id", "ts", doc.alias("weather_data"))


def customer_boxes(cust: DataFrame) -> DataFrame:
    """A box per customer: sides of 0.05 to 6.4 and 0.03 to 0.96 degrees, overlapping,
    every hundredth without a western and every 150th without a northern end."""
    k = F.col("c_custkey")
    lon, lat = (k * 37 % 1000).cast("double") / 25.0 - 5.0, (k * 53 % 997).cast("double") / 50.0 + 45.0
    w, h = F.pow(F.lit(2.0), k % 7) * 0.05, F.pow(F.lit(2.0), k % 5) * 0.03
    return cust.select(F.col("c_name").alias("location"), F.when(k % 97 != 0, k * 7919 % 211).alias("priority"),
                       F.when(k % 100 != 0, lon - w).alias("lon_lo"), (lon + w).alias("lon_hi"),
                       (lat - h).alias("lat_lo"), F.when(k % 150 != 0, lat + h).alias("lat_hi"))


def municipality_lines(cust: DataFrame) -> DataFrame:
    """Municipality documents of the customers as lines of JSON. By the key modulo
    10 some are spoiled: 0 is cut short, 1 has text for a number, 2 lacks a field,
    3 has no number as its code."""
    k = F.col("c_custkey")
    kind, number = k % 10, k.cast("string")
    text = F.concat(F.lit('{"LAU-1 code 1": "'), F.when(kind == 3, F.lit("x")).otherwise(F.lit("")), number, F.lit('", "Municipality": "'), "c_name",
                    F.when(kind == 2, F.lit("")).otherwise(F.concat(F.lit('", "Region": "'), "c_mktsegment")),
                    F.lit('", "Total Area (km²)": '), number, F.lit(', "Latitude": '), F.when(kind == 1, F.lit('"north"')).otherwise(F.lit("55.5")),
                    F.lit(', "not asked for": [1, 2], "PowerRegion": "DK1"}'))
    lines = cust.select(kind.alias("kind"), text.alias("line"))
    return lines.select(F.when(F.col("kind") == 0, F.expr("substring(line, 1, length(line) - 9)")).otherwise(F.col("line")).alias("value"))


AREAS = [(1, "DK1"), (2, "DK2")]  # codes and names of the two areas


def hourly_area_consumption(ev: DataFrame) -> DataFrame:
    """(hour_utc, municipality_number = area code, industry_groups = event type,
    consumption_kwh): ten long series."""
    code = F.when(price_area() == "DK1", F.lit(1)).otherwise(F.lit(2))
    return (ev.groupBy(floor_ntz("ts", "hour").alias("hour_utc"), code.alias("municipality_number"),
                       F.col("event_type").alias("industry_groups"))
              .agg(F.sum(F.col("value").cast(MONEY)).cast("double").alias("consumption_kwh")))


def raw_hours(ev: DataFrame) -> DataFrame:
    """Production rows as a loader meets them: text times (some with a zone, some
    bad), text codes (some bad), NaN measures."""
    k = k_of()
    text = wall_clock_text("ts")
    time = (F.when(k == 1, F.lit("not-a-time")).when(k % 3 == 0, F.concat(text, F.lit("+02:00")))
             .when(k % 3 == 1, F.concat(text, F.lit("Z"))).otherwise(text))
    measures = [F.when(k % 10 == i, F.lit("NaN").cast("double")).otherwise(F.col("value")).alias(c)
                for i, c in enumerate(PRODUCTION_COLUMNS)]
    return ev.select(time.alias("hour_utc"), F.when(k == 5, F.lit("x")).otherwise(F.col("user_id").cast("string"))
                     .alias("municipality_number"), *measures, "event_id")


def raw_tables(ev: DataFrame) -> dict[str, DataFrame]:
    """Consumption, exchange and weather rows as a loader meets them: text times
    (some with a zone, some bad), text codes (some bad), NaN measures."""
    k, nan = k_of(), F.lit("NaN").cast("double")
    text = wall_clock_text("ts")
    time = (F.when(k == 1, F.lit("not-a-time")).when(k % 3 == 0, F.concat(text, F.lit("+02:00")))
             .when(k % 3 == 1, F.concat(text, F.lit("Z"))).otherwise(text))
    spoiled = lambda i: F.when(k % 10 == i, nan).otherwise(F.col("value"))
    return {
        "consumption": ev.select(time.alias("hour_utc"), F.when(k == 5, F.lit("x")).otherwise(F.col("user_id").cast("string")).alias("municipality_number"),
                                 F.col("event_type").alias("industry_groups"), spoiled(0).alias("consumption_kwh")),
        "prodcon": ev.select(time.alias("hour_utc"), price_area().alias("price_area"),
                             *[spoiled(i).alias(c) for i, c in enumerate(EXCHANGE_BY_TYPE.values())]),
        "weather": ev.select(time.alias("timestamp"), F.col("event_type").alias("municipality"), spoiled(3).alias("distance_to_station_km"),
                             F.col("props").alias("weather_data"))}


def hourly_by_type(ev: DataFrame) -> DataFrame:
    """Hourly sums of ``value`` per event type: five long series."""
    return (ev.groupBy("event_type", floor_ntz("ts", "hour").alias("hour_utc"))
              .agg(F.sum(F.col("value").cast(MONEY)).cast("double").alias("value")))


def event_points(ev: DataFrame) -> DataFrame:
    """A (lon, lat) point per event: lon = value / 25 - 5, lat = 45 + k / 5."""
    return ev.select(F.col("event_id").alias("point_id"),
                     (F.col("value") / F.lit(25.0) - F.lit(5.0)).alias("lon"),
                     (F.lit(45.0) + k_of().cast("double") / F.lit(5.0)).alias("lat"))


DAY = _dt.date(2024, 1, 2)          # base + 1 day, the map's day
SLIDER_DAY = _dt.date(2024, 1, 15)  # slider position for cumulative views
BASE_DAY = "2024-01-01"             # day 1 of the slider
SHORT_YEAR_END = _dt.date(2024, 1, 20)  # a year end inside the data
YEAR_END = _dt.date(2024, 12, 31)
SELECTED_HOUR = _dt.datetime(2024, 1, 15, 0, 0, 0)
CLEAN_LO, CLEAN_HI = "2024-01-03 00:00:00", "2024-01-27 23:59:59"
