"""Cross-border exchange: per-zone and per-country import/export splits,
cumulative trade, utilisation levels and shares.

Exchange columns are signed (negative = import, positive = export). Every
query unpivots the measure columns into ``(exchange_column, mwh)`` rows and
computes all the sums it needs in one pass of conditional aggregates grouped
by a handful of keys; the small country dimension is broadcast (fixed size).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridpulse.functions.scalars import (abs_sum_size, fill_template, fmt2, level, on_day,
                                         up_to_day)
from gridpulse.operators.aggregate import share_of_total, sign_split_exprs
from gridpulse.operators.select import unpivot_measures
from gridpulse.sources.dims import (COUNTRY_BY_EXCHANGE, EXCHANGE_COLUMNS, LEVEL_NAMES,
                                    LEVEL_THRESHOLDS, NEIGHBOUR_LABEL, NEIGHBOUR_SIZE_FACTOR,
                                    COUNTRY_SHARE_LABELS, PRICE_AREAS, ZONE_COUNTRY_LABEL,
                                    ZONE_LABEL, ZONE_SHARE_LABELS)

__all__ = [
    "exchange_long", "country_dim", "zone_country_exchange", "zone_summaries",
    "neighbour_utilisation", "daily_cumulative", "zone_share", "country_share",
    "net_locations", "neighbour_trade_literal",
]


def exchange_long(prodcon: DataFrame, measures=EXCHANGE_COLUMNS, ts: str = "hour_utc",
                  area: str = "price_area") -> DataFrame:
    """``(ts, area, exchange_column, mwh)``, NULL measures dropped."""
    return unpivot_measures(prodcon, [ts, area], measures, "exchange_column", "mwh")


def country_dim(spark: SparkSession, rows=COUNTRY_BY_EXCHANGE, measures=None) -> DataFrame:
    """Fixed 4-row country table with its listing order; ``measures`` renames
    the exchange columns (used when other tables stand in for the exchange)."""
    data = []
    for i, (col, name, lat, lon) in enumerate(rows):
        data.append((measures.get(col, col) if measures else col, name, lat, lon, i))
    return spark.createDataFrame(
        data, "exchange_column string, country string, lat double, lon double, ord int")


def _day(day):
    return _dt.date.fromisoformat(str(day)[:10])


def _stamp(day) -> str:
    """The selected day as the labels print it: midnight timestamp text."""
    return f"{_day(day).isoformat()} 00:00:00"


def zone_country_exchange(prodcon: DataFrame, countries: DataFrame, day, areas=PRICE_AREAS,
                          measures=EXCHANGE_COLUMNS, ts: str = "hour_utc",
                          area: str = "price_area") -> DataFrame:
    """Import and export per (zone, country) for one day, 0 where there was none."""
    rows = prodcon.filter(F.col(area).isin(list(areas)) & on_day(ts, day))
    sums = (exchange_long(rows, measures, ts, area)
            .groupBy(area, "exchange_column").agg(*sign_split_exprs("mwh")))
    spark = prodcon.sparkSession
    # the zone x country grid is written out row by row: both lists are fixed
    # and tiny, and every pair must appear even with no trade that day
    grid = spark.createDataFrame([(a, c) for a in areas for c in measures],
                                 f"{area} string, exchange_column string") \
                .join(F.broadcast(countries), "exchange_column")
    out = grid.join(sums, [area, "exchange_column"], "left")
    out = out.select(area, "country", "ord",
                     F.coalesce("import_mwh", F.lit(0)).alias("import_mwh"),
                     F.coalesce("export_mwh", F.lit(0)).alias("export_mwh"))
    text = fill_template(ZONE_COUNTRY_LABEL, country=F.col("country"),
                         import_mwh=fmt2("import_mwh"), export_mwh=fmt2("export_mwh"))
    return out.withColumn("text", text)


def zone_summaries(zone_rows: DataFrame, roles: DataFrame, day, area: str = "price_area") -> DataFrame:
    """One labelled row per zone: the per-country texts joined in listing order."""
    joined = (zone_rows.groupBy(area)
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))),
                                            lambda s: s["text"]), "").alias("fragments")))
    r = roles.select(F.col("name").alias(area), "lat", "lon")
    out = joined.join(F.broadcast(r), area, "left")
    text = fill_template(ZONE_LABEL, zone=F.col(area), day=_stamp(day), fragments=F.col("fragments"))
    return out.select(F.col(area).alias("name"), "lat", "lon", text.alias("text"))


def _country_sums(prodcon: DataFrame, countries: DataFrame, day, year_end, measures, ts, area,
                  areas=None) -> DataFrame:
    d, end = _day(day), _day(year_end or _dt.date(_day(day).year, 12, 31))
    rows = prodcon if areas is None else prodcon.filter(F.col(area).isin(list(areas)))
    long = exchange_long(rows.filter(up_to_day(ts, max(d, end))), measures, ts, area)
    today, cum, year = on_day(ts, d), up_to_day(ts, d), up_to_day(ts, end)
    sums = long.groupBy("exchange_column").agg(
        *sign_split_exprs("mwh", "day_import", "day_export", net="day_net", when=today),
        *sign_split_exprs("mwh", "cum_import", "cum_export", when=cum),
        *sign_split_exprs("mwh", "year_import", "year_export", when=year))
    # one row per exchange column: a proven bound, so the sums are broadcast
    return countries.join(F.broadcast(sums), "exchange_column", "left").na.fill(
        0, ["day_import", "day_export", "day_net", "cum_import", "cum_export",
            "year_import", "year_export"])


def neighbour_utilisation(prodcon: DataFrame, countries: DataFrame, day, year_end=None,
                          measures=EXCHANGE_COLUMNS, ts: str = "hour_utc",
                          area: str = "price_area", thresholds=LEVEL_THRESHOLDS,
                          names=LEVEL_NAMES, size_factor: float = NEIGHBOUR_SIZE_FACTOR,
                          coords: DataFrame | None = None) -> DataFrame:
    """Per neighbour: cumulative import/export to ``day``, year totals, current
    use, yearly maximum, utilisation level and marker size (one scan).

    The label shows the marker coordinates of ``coords`` (``name, lat, lon``,
    e.g. the trade roles) when given, else the country table's."""
    s = _country_sums(prodcon, countries, day, year_end, measures, ts, area)
    s = (s.withColumn("current_use", F.abs("cum_import") + F.abs("cum_export"))
          .withColumn("yearly_max", F.abs("year_import") + F.abs("year_export")))
    s = (s.withColumn("level", level("current_use", "yearly_max", thresholds, names))
          .withColumn("size", abs_sum_size("cum_export", "cum_import", size_factor)))
    if coords is not None:
        c = coords.select(F.col("name").alias("country"), F.col("lat").alias("_label_lat"),
                          F.col("lon").alias("_label_lon"))
        s = s.join(F.broadcast(c), "country", "left")  # a handful of fixed markers
    else:
        s = s.withColumn("_label_lat", F.col("lat")).withColumn("_label_lon", F.col("lon"))
    text = fill_template(NEIGHBOUR_LABEL, country=F.col("country"), lat=F.col("_label_lat"),
                         lon=F.col("_label_lon"), day=_stamp(day),
                         cum_export=fmt2("cum_export"), cum_import=fmt2("cum_import"),
                         current_use=fmt2("current_use"), yearly_max=fmt2("yearly_max"))
    return s.withColumn("text", text).drop("_label_lat", "_label_lon")


def daily_cumulative(prodcon: DataFrame, countries: DataFrame, measures=EXCHANGE_COLUMNS,
                     ts: str = "hour_utc", area: str = "price_area") -> DataFrame:
    """For every day and country: that day's import/export and the running
    totals up to it (daily aggregate first, then a per-country running sum
    over at most one row per day)."""
    daily = (exchange_long(prodcon, measures, ts, area)
             .groupBy("exchange_column", F.to_date(ts).alias("day"))
             .agg(*sign_split_exprs("mwh", "day_import", "day_export")))
    w = Window.partitionBy("exchange_column").orderBy("day") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = daily.select("*", F.sum("day_import").over(w).alias("cum_import"),
                         F.sum("day_export").over(w).alias("cum_export"))
    return daily.join(F.broadcast(countries.select("exchange_column", "country")), "exchange_column")


def _directions(df: DataFrame, keys, imp: str, exp: str, labels) -> DataFrame:
    """Two rows per key: import and export magnitudes, with their slice labels."""
    long = df.select(*keys, F.explode(F.array(
        F.struct(F.lit("import").alias("direction"), F.lit(labels[0]).alias("label"),
                 F.abs(F.col(imp)).cast("double").alias("mwh")),
        F.struct(F.lit("export").alias("direction"), F.lit(labels[1]).alias("label"),
                 F.abs(F.col(exp)).cast("double").alias("mwh")))
    ).alias("d"))
    return long.select(*keys, "d.direction", "d.label", "d.mwh")


def zone_share(prodcon: DataFrame, countries: DataFrame, day, areas=PRICE_AREAS,
               measures=EXCHANGE_COLUMNS, ts: str = "hour_utc", area: str = "price_area") -> DataFrame:
    """Import vs export share per (zone, country) for one day."""
    z = zone_country_exchange(prodcon, countries, day, areas, measures, ts, area)
    d = _directions(z, [area, "country"], "import_mwh", "export_mwh", ZONE_SHARE_LABELS)
    return share_of_total(d, [area, "country"], "mwh")


def country_share(prodcon: DataFrame, countries: DataFrame, day, measures=EXCHANGE_COLUMNS,
                  ts: str = "hour_utc", area: str = "price_area") -> DataFrame:
    """Cumulative (to ``day``) import vs export share per country, all zones."""
    s = _country_sums(prodcon, countries, day, day, measures, ts, area)  # nothing later than the day
    d = _directions(s, ["country"], "cum_import", "cum_export", COUNTRY_SHARE_LABELS)
    return share_of_total(d, ["country"], "mwh")


def net_locations(prodcon: DataFrame, countries: DataFrame, day, areas=PRICE_AREAS,
                  measures=EXCHANGE_COLUMNS, ts: str = "hour_utc",
                  area: str = "price_area") -> DataFrame:
    """Countries whose net exchange on ``day`` (given zones) is non-zero."""
    rows = prodcon.filter(F.col(area).isin(list(areas)) & on_day(ts, day))
    totals = exchange_long(rows, measures, ts, area).groupBy("exchange_column") \
        .agg(F.sum("mwh").alias("value"))
    out = F.broadcast(countries).join(totals, "exchange_column")
    return out.filter(F.col("value").isNotNull() & (F.col("value") != 0)) \
              .select(F.col("country").alias("name"), "lat", "lon", "value")


def neighbour_trade_literal(prodcon: DataFrame, roles: DataFrame, day, year_end=None,
                            measures=EXCHANGE_COLUMNS, ts: str = "hour_utc",
                            area: str = "price_area", swapped=("Great Britain",), areas=PRICE_AREAS,
                            thresholds=LEVEL_THRESHOLDS, names=LEVEL_NAMES,
                            size_factor: float = NEIGHBOUR_SIZE_FACTOR) -> DataFrame:
    """Neighbour figures with the role columns taken literally: each
    neighbour's export is the net sum of its ``export_column`` and its import
    the net sum of its ``import_column`` (the two swap for ``swapped``
    names). Day values count the given zones only, cumulative and year
    totals every row. One pass of net sums per exchange column, then two
    lookups."""
    d, end = _day(day), _day(year_end or _dt.date(_day(day).year, 12, 31))
    long = exchange_long(prodcon.filter(up_to_day(ts, max(d, end))), measures, ts, area)
    sums = long.groupBy("exchange_column").agg(
        F.coalesce(F.sum(F.when(on_day(ts, d) & F.col(area).isin(list(areas)), F.col("mwh"))),
                   F.lit(0)).alias("day_net"),
        F.coalesce(F.sum(F.when(up_to_day(ts, d), F.col("mwh"))), F.lit(0)).alias("cum_net"),
        F.coalesce(F.sum(F.when(up_to_day(ts, end), F.col("mwh"))), F.lit(0)).alias("year_net"))
    sums = F.broadcast(sums)  # one row per exchange column: at most len(measures) rows
    r = roles.filter(~F.col("is_dk"))
    swap = F.col("name").isin(list(swapped))
    r = r.select("name", "lat", "lon",
                 F.when(swap, F.col("import_column")).otherwise(F.col("export_column")).alias("_exp_col"),
                 F.when(swap, F.col("export_column")).otherwise(F.col("import_column")).alias("_imp_col"))
    e = sums.select(F.col("exchange_column").alias("_exp_col"), F.col("day_net").alias("day_export"),
                    F.col("cum_net").alias("cum_export"), F.col("year_net").alias("year_export"))
    i = sums.select(F.col("exchange_column").alias("_imp_col"), F.col("day_net").alias("day_import"),
                    F.col("cum_net").alias("cum_import"), F.col("year_net").alias("year_import"))
    out = r.join(e, "_exp_col", "left").join(i, "_imp_col", "left").na.fill(
        0, ["day_export", "cum_export", "year_export", "day_import", "cum_import", "year_import"])
    out = (out.withColumn("current_use", F.abs("cum_import") + F.abs("cum_export"))
              .withColumn("yearly_max", F.abs("year_import") + F.abs("year_export")))
    out = (out.withColumn("level", level("current_use", "yearly_max", thresholds, names))
              .withColumn("size", abs_sum_size("cum_export", "cum_import", size_factor)))
    return out.drop("_exp_col", "_imp_col").withColumnRenamed("name", "country")
