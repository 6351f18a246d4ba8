"""Weather-property maps: a JSON property per station and hour, its daily sum,
mean and sample standard deviation, a z-score marker size and a per-day
colour scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.jsonx import (document_has, document_number, document_text, keep_last_of_repeated_keys, replace_exact,
                                       with_document)
from gridpulse.functions.scalars import col_of, fill_template, fmt2, on_day, palette_index, rescale, short_date
from gridpulse.operators.joins import semi_join_values
from gridpulse.operators.scan import null_safe_join
from gridpulse.sources.dims import (MUNICIPALITY_ALIASES, WEATHER_LABEL, PALETTE_SIZES, WEATHER_PALETTES,
                                    WEATHER_Z_FACTOR)

__all__ = ["station_property", "property_day_zscore"]


def station_property(weather: DataFrame, ts: str, station, json_col: str, prop: str,
                     aliases: dict = MUNICIPALITY_ALIASES, default: float | None = None,
                     station_out: str = "municipality", value_out: str = "value",
                     keep=(), station_key: str | None = None, has_out: str | None = None) -> DataFrame:
    """One typed row per observation: canonical station name, time, property value.

    ``station`` is a column name or Column; with ``station_key`` (and ``station``
    None) the name is that field of the document. Names are canonicalised with
    whole-value ``aliases``. The document is parsed once, strictly: malformed text,
    or text with anything behind the value, has no fields. Of repeated keys the
    last counts (set for the session). ``default`` is the value of an object
    without the property, ``has_out`` a flag whether it has it. A consumer that
    reads the result twice parses the JSON twice unless the result is materialised."""
    keep_last_of_repeated_keys(weather.sparkSession)
    doc = "__gp_document"
    parsed = with_document(weather, json_col, doc)
    name = document_text(doc, station_key) if station_key else col_of(station)
    flag = [F.coalesce(document_has(doc, prop), F.lit(False)).alias(has_out)] if has_out else []
    return parsed.select(*keep, replace_exact(name, aliases).alias(station_out), F.col(ts).alias(ts),
                         document_number(doc, prop, default).alias(value_out), *flag)


def day_statistics(obs: DataFrame, station: str, value: str, factor: float) -> tuple[DataFrame, DataFrame]:
    """Per (station, day): ``day_sum`` (0 for no values), ``mean`` and sample ``std``;
    and per day the bounds ``_lo``, ``_hi`` of the z-score sizes.

    All of it comes from one table of (station, day, value, count), whose exchange
    is shared: the means are added up over it, and the squared deviations, the
    nearest and the farthest value in a second look. So the observations are read
    once, and the deviations are never a difference of large sums."""
    keys, v, n = [station, "day"], F.col(value), F.col("_n")
    cells = obs.groupBy(*keys, v).agg(F.count(v).alias("_n"))
    means = cells.groupBy(*keys).agg(F.sum("_n").alias("_total"), F.sum(v * n).alias("day_sum")) \
        .withColumn("mean", F.col("day_sum") / F.nullif("_total", F.lit(0)))
    off = F.abs(v - F.col("mean"))
    stats = null_safe_join(cells, means, keys).groupBy(*keys, "day_sum", "mean", "_total") \
        .agg(F.sum(off * off * n).alias("_m2"), F.min(off).alias("_near"), F.max(off).alias("_far"))
    stats = stats.withColumn("std", F.sqrt(F.col("_m2") / F.nullif(F.col("_total") - 1, F.lit(0))))
    size = lambda c: F.col(c) / F.nullif("std", F.lit(0.0)) * F.lit(float(factor))
    bounds = stats.groupBy("day").agg(F.min(size("_near")).alias("_lo"), F.max(size("_far")).alias("_hi"))
    return stats.select(*keys, F.coalesce("day_sum", F.lit(0.0)).alias("day_sum"), "mean", "std"), bounds


def property_day_zscore(obs: DataFrame, ts: str, station: str = "municipality",
                        value: str = "value", enabled=None,
                        enabled_col: str = "municipality", day=None,
                        factor: float = WEATHER_Z_FACTOR, out_lo: float = 0.3, out_hi: float = 1.0,
                        n_colors: int | None = None, prop: str | None = None,
                        materialize: bool = False) -> DataFrame:
    """Z-score sizes per (station, day), then a colour scale per day.

    With ``prop`` (the property name) each row also gets the palette name
    and the station-day label. The observations are read twice, for the
    statistics and for the rows; ``materialize=True`` checkpoints the typed
    observations once to the shared checkpoint folder, so the JSON is parsed
    once. ``enabled`` restricts stations: a list of names (an ``isin`` filter) or a
    frame (a semi join, planned by size). ``day`` limits
    to one calendar day; without it every day is computed at once."""
    if day is not None:
        obs = obs.filter(on_day(ts, day))
    if isinstance(enabled, (list, tuple)):
        obs = obs.filter(F.col(station).isin(list(enabled)))
    elif enabled is not None:
        obs = semi_join_values(obs, station, enabled, enabled_col)
    obs = obs.withColumn("day", F.to_date(ts))
    if materialize:
        from gridpulse.session import materialize as _materialize
        obs = _materialize(obs)
    bounded = isinstance(enabled, (list, tuple))  # days of a fixed list of stations
    stats, bounds = day_statistics(obs, station, value, factor)
    sized = null_safe_join(obs, F.broadcast(stats) if bounded else stats, [station, "day"])
    sized = sized.withColumn("z_size", F.abs(F.col(value) - F.col("mean")) / F.nullif("std", F.lit(0.0)) * F.lit(float(factor)))
    # one bounds row per calendar day: broadcast, the rows stay where they are
    out = null_safe_join(sized, F.broadcast(bounds), ["day"]).withColumn("scale", rescale("z_size", "_lo", "_hi", out_lo, out_hi))
    n_colors = n_colors or PALETTE_SIZES.get(WEATHER_PALETTES.get(prop), 9)
    out = out.withColumn("color_index", palette_index("scale", n_colors, clip_range=True)).drop("_lo", "_hi")
    if prop is None:
        return out
    text = fill_template(WEATHER_LABEL, municipality=F.col(station), prop=prop,
                         day_sum=fmt2("day_sum"), day=short_date("day"))
    return out.withColumn("palette", F.lit(WEATHER_PALETTES.get(prop))).withColumn("text", text)
