"""The dashboard's questions as lazy DataFrame plans (Q1-Q15).

Defaults use the domain column names (hourly ``production``, ``consumption``,
``prodcon`` and ``weather`` tables and the ``municipalities`` dimension, as
returned by ``gridpulse.sources`` typed loaders); every name is a parameter,
so other tables can stand in. Each function computes its answer for every
entity at once and is keyed, never positional.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.scalars import (fill_template, floor_ntz, fmt2, iso_hour, label_lines,
                                         marker_size, month_day_label, ts_literal)
from gridpulse.functions.jsonx import replace_exact
from gridpulse.operators.aggregate import day_totals, first_non_null, zero_filled
from gridpulse.operators.clean import parse_time_window, require_columns, to_kwh
from gridpulse.operators.impute import fill_gaps
from gridpulse.operators.joins import left_join_keep_first, reverse_lookup
from gridpulse.operators.scale import running_rescale
from gridpulse.operators.series import smooth
from gridpulse.operators.spatial import classify_points, valid_points
from gridpulse.sources.dims import (BASE_DAY, CLOSED_BOUNDS, CONSUMPTION_LABEL,
                                    CONSUMPTION_PALETTES, CONSUMPTION_SIZE_FACTOR, DISTANCE_LABEL,
                                    MUNICIPALITY_ALIASES, MUNICIPALITY_LABEL_LINES, OPEN_BOUNDS, PALETTE_SIZES,
                                    PRODUCTION_LABEL,
                                    PRODUCTION_PALETTE_DEFAULT, PRODUCTION_PALETTES,
                                    PRODUCTION_SIZE_FACTOR, SMOOTH_KEEP_RATIO)

__all__ = [
    "MUNICIPALITY_LABEL", "municipality_profile", "production_map", "consumption_map",
    "hourly_series", "selected_hour", "region_points", "clean_weather", "clean_hourly",
    "calendar_marks",
]

MUNICIPALITY_LABEL = MUNICIPALITY_LABEL_LINES
HOURS_OF_A_YEAR = 366 * 24  # most rows of one yearly plot


def municipality_profile(municipalities: DataFrame, weather: DataFrame,
                         key: str = "municipality", weather_key: str = "municipality",
                         distance: str = "distance_to_station_km", order=("timestamp",),
                         label=MUNICIPALITY_LABEL, out: str = "hover_text",
                         aliases=MUNICIPALITY_ALIASES) -> DataFrame:
    """Q1: dimension rows with their station distance (first non-null per
    station in time order) and a multi-line label. Station names are made
    canonical with the whole-value ``aliases`` before the join, so an alias
    row still finds its municipality (pass ``{}`` for non-text keys)."""
    rows = weather.filter(F.col(distance).isNotNull())
    if aliases:
        rows = rows.withColumn(weather_key, replace_exact(weather_key, aliases))
    dist = first_non_null(rows, [weather_key], distance, list(order))
    if weather_key != key:
        dist = dist.withColumnRenamed(weather_key, key)
    joined = left_join_keep_first(municipalities, dist, on=key)
    text = label_lines([(p, F.col(c)) for p, c in label],
                       optional=[(DISTANCE_LABEL.replace("{distance}", ""), F.col(distance))])
    return joined.withColumn(out, text)


def production_map(production: DataFrame, dim: DataFrame, day, measure: str,
                   code: str = "municipality_number", ts: str = "hour_utc",
                   dim_key: str = "lau_1_code_1", dim_label: str | None = "hover_text",
                   n_colors: int | None = None,
                   size_factor: float = PRODUCTION_SIZE_FACTOR) -> DataFrame:
    """Q2: every dimension row with its day total of ``measure`` (0 if none),
    marker size, running colour scale in key order and label."""
    require_columns(production, [code, ts, measure])
    palette = PRODUCTION_PALETTES.get(measure, PRODUCTION_PALETTE_DEFAULT)
    totals = day_totals(production, [code], ts, measure, day, out="total_mwh")
    keep = [dim_key] + ([dim_label] if dim_label else [])
    m = zero_filled(dim.select(*keep), dim_key, totals, code, ["total_mwh"])
    m = (m.withColumn("total_kwh", to_kwh("total_mwh"))
          .withColumn("size", marker_size("total_mwh", size_factor)))
    m = running_rescale(m, dim_key, "size", out="scale", out_lo=0.0, out_hi=1.0,
                        n_colors=n_colors or PALETTE_SIZES[palette])
    head = F.col(dim_label) if dim_label else F.lit("")
    text = fill_template(PRODUCTION_LABEL, label=head, code=F.col(dim_key), measure=measure,
                         kwh=fmt2("total_kwh"), day=str(day)[:10])
    return m.select(F.col(dim_key).alias("code"), "total_mwh", "total_kwh", "size", "scale",
                    "color_index", F.lit(palette).alias("palette"), text.alias("text"))


def consumption_map(consumption: DataFrame, dim: DataFrame, day, group: str | None = None,
                    code: str = "municipality_number", ts: str = "hour_utc",
                    group_col: str = "industry_groups", value: str = "consumption_kwh",
                    dim_key: str = "lau_1_code_1", dim_label: str | None = "hover_text",
                    n_colors: int | None = None,
                    default_palette: str = "Oranges") -> DataFrame:
    """Q3: as Q2 for consumption, optionally one industry group; scale [0.3, 1]."""
    palette = CONSUMPTION_PALETTES.get(group, default_palette)
    rows = consumption if group is None else consumption.filter(F.col(group_col) == F.lit(group))
    totals = day_totals(rows, [code], ts, value, day, out="total_kwh")
    keep = [dim_key] + ([dim_label] if dim_label else [])
    m = zero_filled(dim.select(*keep), dim_key, totals, code, ["total_kwh"])
    m = m.withColumn("size", marker_size("total_kwh", CONSUMPTION_SIZE_FACTOR))
    m = running_rescale(m, dim_key, "size", out="scale", out_lo=0.3, out_hi=1.0,
                        n_colors=n_colors or PALETTE_SIZES[palette])
    head = F.col(dim_label) if dim_label else F.lit("")
    text = fill_template(CONSUMPTION_LABEL, label=head, code=F.col(dim_key), group=str(group),
                         kwh=fmt2("total_kwh"), day=str(day)[:10])
    return m.select(F.col(dim_key).alias("code"), "total_kwh", "size", "scale", "color_index",
                    F.lit(palette).alias("palette"), text.alias("text"))


def selected_hour(day_number: int, base: str = BASE_DAY) -> _dt.datetime:
    """Slider day d (1-based) -> midnight of base + (d - 1)."""
    return _dt.datetime.combine(_dt.date.fromisoformat(base), _dt.time()) \
        + _dt.timedelta(days=day_number - 1)


def hourly_series(df: DataFrame, keys, ts: str, value: str, selected=None,
                  keep_ratio: float = SMOOTH_KEEP_RATIO, chunk=None,
                  names: DataFrame | None = None, name_col: str | None = None,
                  dim: DataFrame | None = None, dim_name: str | None = None,
                  dim_code: str | None = None, order_extra=(), names_key: str | None = None,
                  max_points: int | None = None) -> DataFrame:
    """Q7-Q9: raw and smoothed yearly series for every series key at once,
    with the ISO hour and an ``is_selected`` flag for the selected hour.

    Optionally restrict to series named in ``names`` resolved to codes through
    ``dim`` (reverse lookup; unknown names simply select nothing); the codes are
    those of ``names_key``, by default the first key.
    ``order_extra`` breaks ties of ``ts`` within a series (e.g. an id).
    ``max_points`` is the most rows that a series can have, if the caller knows it
    (``HOURS_OF_A_YEAR`` for one calendar year of hourly rows)."""
    keys = list(keys)
    require_columns(df, [*keys, ts, value])
    if names is not None:
        codes = reverse_lookup(names, name_col, dim, dim_name, dim_code, out="_code") \
            .filter(F.col("_code").isNotNull()).select("_code").distinct()
        df = df.join(codes, df[names_key or keys[0]] == codes["_code"], "left_semi")
    out = smooth(df, keys, [ts, *order_extra], value, keep_ratio=keep_ratio, chunk=chunk, max_points=max_points)
    flag = F.lit(False) if selected is None else \
        F.coalesce(F.col(ts) == ts_literal(selected), F.lit(False))
    return out.select(*keys, *order_extra, F.col(ts), iso_hour(ts).alias("iso"), "raw", "smoothed",
                      flag.alias("is_selected"))


def region_points(points: DataFrame, lon: str = "lon", lat: str = "lat",
                  open_bounds=OPEN_BOUNDS, closed_bounds=CLOSED_BOUNDS) -> DataFrame:
    """Q13: region of each point (open boxes, first match) and whether it lies
    in any closed box — one pass, no join."""
    out = classify_points(points, lon, lat, open_bounds, closed=False, out="region")
    return valid_points(out, lon, lat, closed_bounds, closed=True, out="is_valid")


def clean_weather(weather: DataFrame, lo: str = "2022-01-01 00:00:00",
                  hi: str = "2022-12-31 23:59:59", text_col: str = "timestamp") -> DataFrame:
    """Q14 (weather): drop NULL text, strict parse, closed time window."""
    return parse_time_window(weather, text_col, lo, hi)


def clean_hourly(df: DataFrame, keys, ts: str, measures, chunk_unit: str | None = "month") -> DataFrame:
    """Q14 (hourly tables): interpolate -> ffill -> bfill the measures per
    series in time order, chunked by calendar ``chunk_unit``.

    With hourly rows a month chunk holds at most 744 rows of a series, so no
    task holds more than that per series, and the carry summary is about
    1/720 of the rows."""
    chunk = None if chunk_unit is None else floor_ntz(ts, chunk_unit)
    return fill_gaps(df, keys, [ts], measures, chunk=chunk)


def calendar_marks(ts_source: DataFrame, ts: str, every: int = 30) -> DataFrame:
    """Q15: the day dimension spanned by the data (day number from 1, date,
    ``Month dd`` label on every ``every``-th day starting with the first)."""
    span = ts_source.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.select("lo", F.explode(F.sequence("lo", "hi")).alias("date"))
    days = days.select((F.datediff("date", "lo") + 1).cast("int").alias("day_number"), "date")
    label = F.when((F.col("day_number") - 1) % every == 0, month_day_label("date"))
    return days.withColumn("label", label)
