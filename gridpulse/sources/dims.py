"""Small fixed dimensions (exchange countries, trade roles, map boxes...).

They are a few rows each, so joins against them are broadcast with a proven
size bound. Callers may pass their own frames with the same columns instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values. These must equal the constants of the dashboard this library
# reproduces; they are kept together, in their original order, as plain data.
# ---------------------------------------------------------------------------

PRODUCTION_COLUMNS = [
    "offshore_wind_mwh_gte_100",
    "offshore_wind_mwh_lt_100",
    "onshore_wind_power_mwh",
    "solar_power_mwh",
    "thermal_power_production",
]

INDUSTRY_GROUPS = ["Privat", "Offentligt", "Erhverv"]

WEATHER_PROPERTIES = [
    "temp", "dwpt", "rhum", "prcp", "snow", "wdir",
    "wspd", "wpgt", "pres", "tsun", "coco",
]

EXCHANGE_COLUMNS = ["exchangegb_mwh", "exchangege_mwh", "exchangenl_mwh", "exchangeno_mwh"]

# exchange column -> (country, lat, lon)
COUNTRY_BY_EXCHANGE = [
    ("exchangegb_mwh", "Great Britain", 51.5074, -0.1278),
    ("exchangenl_mwh", "Netherlands", 52.3676, 4.9041),
    ("exchangege_mwh", "Germany", 52.52, 13.4050),
    ("exchangeno_mwh", "Norway", 59.9139, 10.7522),
]

# (name, lat, lon, export_column, import_column, is_dk)
TRADE_ROLES = [
    ("DK1", 56.1496, 10.2134, None, None, True),
    ("DK2", 55.6761, 12.5683, None, None, True),
    ("Germany", 52.52, 13.405, "exchangege_mwh", "exchangenl_mwh", False),
    ("Netherlands", 52.3676, 4.9041, "exchangenl_mwh", "exchangege_mwh", False),
    ("Norway", 60.472, 8.4689, "exchangeno_mwh", "exchangege_mwh", False),
    ("Great Britain", 51.5074, -0.1278, "exchangegb_mwh", "exchangege_mwh", False),
]

PRICE_AREAS = ["DK1", "DK2"]

# Closed boxes, any match counts: (location, lon_lo, lon_hi, lat_lo, lat_hi)
CLOSED_BOUNDS = [
    ("DK1", 8.0, 10.0, 54.0, 56.0),
    ("DK2", 13.0, 15.0, 54.0, 56.0),
    ("Great Britain", -2.0, 1.0, 50.0, 59.0),
    ("Germany", 11.0, 14.0, 47.0, 55.0),
    ("Netherlands", 3.0, 6.0, 50.0, 54.0),
    ("Norway", 8.0, 10.0, 58.0, 62.0),
]

# Open boxes (strict bounds), first match in this order wins; None = unbounded.
OPEN_BOUNDS = [
    ("DK1", 7.0, 12.0, 54.0, 57.0),
    ("DK2", 12.0, 15.0, 54.0, 57.0),
    ("Great Britain", None, 2.0, 50.0, None),
    ("Germany", 11.0, 14.0, 47.0, 55.0),
    ("Netherlands", 3.0, 6.0, 50.0, 53.0),
    ("Norway", 4.0, 10.0, 58.0, 63.0),
]

ENABLED_MUNICIPALITIES = ["København", "Aarhus", "Aalborg", "Odense", "Esbjerg"]

MUNICIPALITY_ALIASES = {"Copenhagen": "København"}

PRODUCTION_PALETTES = {
    "thermal_power_production": "Reds",
    "solar_power_mwh": "YlOrBr",
    "onshore_wind_power_mwh": "Teal",
}
PRODUCTION_PALETTE_DEFAULT = "Blues"

CONSUMPTION_PALETTES = {"Privat": "Oranges", "Offentligt": "Agsunset", "Erhverv": "Reds"}

WEATHER_PALETTES = {
    "temp": "thermal", "wspd": "Darkmint", "rhum": "PuBuGn", "prcp": "PuBu",
    "coco": "Greys", "wdir": "Turbo", "pres": "Agsunset", "snow": "ice",
    "tsun": "solar", "wpgt": "speed", "dwpt": "deep",
}

# Steps of each palette (fixed values).
PALETTE_SIZES = {
    "Reds": 9, "YlOrBr": 9, "Teal": 7, "Blues": 9, "Oranges": 9, "Agsunset": 7, "thermal": 12, "Darkmint": 7,
    "PuBuGn": 9, "PuBu": 9, "Greys": 9, "Turbo": 15, "ice": 12, "solar": 12, "speed": 12, "deep": 12,
}

PRODUCTION_SIZE_FACTOR = 7.0
CONSUMPTION_SIZE_FACTOR = 4.0
WEATHER_Z_FACTOR = 15.0
NEIGHBOUR_SIZE_FACTOR = 7.0
LEVEL_THRESHOLDS = (0.8, 0.95)
LEVEL_NAMES = ("green", "yellow", "red")
SMOOTH_KEEP_RATIO = 0.02
BASE_DAY = "2022-01-01"

# Label formats. {name} marks a value; numbers shown with two decimals are
# formatted before they are filled in.
MUNICIPALITY_LABEL_LINES = [
    ("", "municipality"),
    ("Latitude: ", "latitude"),
    ("Longitude: ", "longitude"),
    ("PowerRegion: ", "power_region"),
    ("LAU-1 Code: ", "lau_1_code_1"),
    ("Administrative Center: ", "administrative_center"),
    ("Total Area (km²): ", "total_area_km2"),
    ("Population (2012-01-01): ", "population_2012_01_01"),
    ("Region: ", "region"),
]
DISTANCE_LABEL = "Distance to Station (km): {distance}"
PRODUCTION_LABEL = ("{label}<br>Municipality Number: {code}<br>Production Type: {measure}"
                    "<br>Power Production: {kwh} kWh<br>Selected Day: {day}")
CONSUMPTION_LABEL = ("{label}<br>Municipality Number: {code}<br>Industry Group: {group}"
                     "<br>Power Consumption: {kwh} kWh<br>Selected Day: {day}")
ZONE_COUNTRY_LABEL = ("Import from {country}: {import_mwh} MWh<br>"
                      "Export to {country}: {export_mwh} MWh<br>")
ZONE_LABEL = "{zone}<br>Daily values for Selected Day:{day}<br>{fragments}"
NEIGHBOUR_LABEL = ("{country}<br>Latitude:{lat}<br>Longitude:{lon}<br>"
                   "Cumulative Trade Numbers up until Selected Day: {day}<br>"
                   "Total Export to {country}: {cum_export} MWh<br>"
                   "Total Import from {country}: {cum_import} MWh<br>"
                   "Current Use: {current_use} MWh<br>Yearly Max: {yearly_max} MWh")
WEATHER_LABEL = ("<br>Municipality Center for Weather Data Collection: {municipality}"
                 "<br>Weather Property: {prop}<br>Sum of {prop} for the Selected Day: {day_sum}"
                 "<br>Selected Day: {day}")
ZONE_SHARE_LABELS = ("Import", "Export")
COUNTRY_SHARE_LABELS = ("(MWh) Import from", "(MWh) Export to")
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Box:
    """An axis-aligned lon/lat box; ``None`` on a side means unbounded."""

    location: str
    lon_lo: float | None
    lon_hi: float | None
    lat_lo: float | None
    lat_hi: float | None


def boxes(rows) -> list[Box]:
    """Box records from bound rows."""
    return [Box(*r) for r in rows]


def trade_roles_frame(spark: SparkSession) -> DataFrame:
    """The six map markers with their role columns."""
    return spark.createDataFrame(
        TRADE_ROLES,
        "name string, lat double, lon double, export_column string, "
        "import_column string, is_dk boolean")


def bounds_frame(spark: SparkSession, rows=CLOSED_BOUNDS) -> DataFrame:
    """Bounds as a frame with an explicit ``priority`` (list order)."""
    data = [(i,) + tuple(r) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "priority int, location string, lon_lo double, lon_hi double, "
              "lat_lo double, lat_hi double")


def names_frame(spark: SparkSession, names, column: str = "municipality") -> DataFrame:
    """A one-column frame of names (e.g. the enabled stations)."""
    return spark.createDataFrame([(n,) for n in names], f"{column} string")
