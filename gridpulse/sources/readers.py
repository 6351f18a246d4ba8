"""Readers and typed loaders for the hourly tables and the municipality dimension.

A connector is only a ``format`` plus options here: parquet by default, any
Spark data source (a catalog table, a JDBC or other connector the caller has
on the classpath, JSON documents...) through the same call. Typed loaders cast
keys to INT, times to TIMESTAMP_NTZ and NaN to NULL once, at load.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.scalars import lenient_timestamp, nan_to_null
from gridpulse.sources.dims import EXCHANGE_COLUMNS, PRODUCTION_COLUMNS

__all__ = [
    "read_table", "read_documents", "split_documents", "save_hourly", "normalise_columns", "snake_columns",
    "typed_production", "typed_consumption", "typed_prodcon", "typed_weather",
    "typed_municipalities", "MUNICIPALITY_DOC_SCHEMA", "MUNICIPALITY_FIELDS", "write_table",
]


def read_table(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
               table: str | None = None, options: dict | None = None,
               schema=None) -> DataFrame:
    """Scan a table: ``spark.table(table)`` for catalog tables, else ``format(fmt).load(path)``."""
    if table is not None:
        return spark.table(table)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    """Sink: write a result (optionally partitioned, e.g. by month) instead of
    bringing it to the driver."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


# Field names of the municipality documents (source names, in load order).
MUNICIPALITY_FIELDS = [
    "LAU-1 code 1", "Municipality", "Administrative Center", "Total Area (km²)",
    "Population (2012-01-01)", "Region", "Latitude", "Longitude", "PowerRegion",
]

MUNICIPALITY_DOC_SCHEMA = (
    "`LAU-1 code 1` string, `Municipality` string, `Administrative Center` string, "
    "`Total Area (km²)` double, `Population (2012-01-01)` bigint, `Region` string, "
    "`Latitude` double, `Longitude` double, `PowerRegion` string"
)


def read_documents(spark: SparkSession, path: str, fields=MUNICIPALITY_FIELDS,
                   schema: str = MUNICIPALITY_DOC_SCHEMA, corrupt: str | None = None) -> DataFrame:
    """Document scan (JSON lines) with an inclusion projection and a fixed schema.

    With ``corrupt`` the text of a line that is no such document (cut short, or a
    field of another type) stands in a column of that name, NULL for good lines."""
    if corrupt is None:
        return spark.read.schema(schema).json(path).select(*[F.col(f"`{f}`") for f in fields])
    # Spark's file reader will not give the spoiled lines alone, so lines are read as text.
    lines = spark.read.text(path).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = lines.select(F.from_json("value", f"{schema}, `{corrupt}` string", options).alias("d"))
    return parsed.select(*[F.col(f"d.`{f}`") for f in [*fields, corrupt]])


def split_documents(docs: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a scan with a corrupt column: the documents without
    that column, and the texts of the rest with what their fields gave."""
    return docs.where(F.col(corrupt).isNull()).drop(corrupt), docs.where(F.col(corrupt).isNotNull())


def save_hourly(df: DataFrame, table: str, path: str, key: str, ts: str | None = None, buckets: int = 64,
                month: str = "month") -> DataFrame:
    """Write a catalog table bucketed and sorted by ``key`` (and by ``ts``,
    partitioned by its calendar month, if given) and scan it. Joins and
    aggregations of such tables on ``key`` need no exchange if their numbers of
    buckets are equal, and a filter or join on the month prunes partitions."""
    if ts is not None:
        df = df.withColumn(month, F.date_format(F.to_date(ts), "yyyy-MM"))
    # a bucket of a month is one file: rows are dealt once, as they are stored
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    if ts is not None:
        writer = writer.partitionBy(month)
    writer.bucketBy(buckets, key).sortBy(key, *([ts] if ts else [])).saveAsTable(table)
    return df.sparkSession.table(table)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def _snake(name: str) -> str:
    s = re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name.strip()).lower().replace("²", "2")
    s = re.sub(r"[^0-9a-z]+", "_", s)
    return s.strip("_")


def snake_columns(df: DataFrame) -> DataFrame:
    """``'Total Area (km²)'`` -> ``total_area_km2`` and so on."""
    return df.toDF(*[_snake(c) for c in df.columns])


def _measures(df: DataFrame, cols) -> list:
    return [nan_to_null(F.col(c).cast("double")).alias(c) for c in cols]


def typed_production(df: DataFrame, measures=PRODUCTION_COLUMNS, keep=()) -> DataFrame:
    """Production with typed time, INT code and NaN-free DOUBLE measures; columns
    in ``keep`` stay as they are."""
    return df.select(
        *keep,
        lenient_timestamp("hour_utc", dict(df.dtypes)["hour_utc"]).alias("hour_utc"),
        F.col("municipality_number").try_cast("int").alias("municipality_number"),
        *_measures(df, measures))


def typed_consumption(df: DataFrame) -> DataFrame:
    """Consumption with typed time, INT code, group and DOUBLE kWh."""
    return df.select(
        lenient_timestamp("hour_utc", dict(df.dtypes)["hour_utc"]).alias("hour_utc"),
        F.col("municipality_number").try_cast("int").alias("municipality_number"),
        F.col("industry_groups").cast("string").alias("industry_groups"),
        *_measures(df, ["consumption_kwh"]))


def typed_prodcon(df: DataFrame, measures=EXCHANGE_COLUMNS) -> DataFrame:
    """Exchange table with typed time, price area and DOUBLE exchange columns."""
    return df.select(
        lenient_timestamp("hour_utc", dict(df.dtypes)["hour_utc"]).alias("hour_utc"),
        F.col("price_area").cast("string").alias("price_area"),
        *_measures(df, measures))


def typed_weather(df: DataFrame) -> DataFrame:
    """Weather keeps its text timestamp; ``clean.parse_time_window`` parses it."""
    return df.select(
        F.col("timestamp").cast("string").alias("timestamp"),
        F.col("municipality").cast("string").alias("municipality"),
        nan_to_null(F.col("distance_to_station_km").cast("double")).alias("distance_to_station_km"),
        F.col("weather_data").cast("string").alias("weather_data"))


def typed_municipalities(df: DataFrame) -> DataFrame:
    """Source field names -> snake_case, code as INT (it may arrive as text)."""
    df = snake_columns(df)
    return df.withColumn("lau_1_code_1", F.col("lau_1_code_1").try_cast("int"))
