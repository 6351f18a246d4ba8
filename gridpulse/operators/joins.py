"""Dimension joins: collision-safe left joins, semi-joins, reverse lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.scalars import ts_literal

__all__ = ["left_join_keep_first", "semi_join_values", "series_with_hour", "reverse_lookup"]


def left_join_keep_first(left: DataFrame, right: DataFrame, on: str,
                         suffix: str = "_from_right", fill_from_right: bool = False) -> DataFrame:
    """Left equi-join; a column present on both sides keeps the left column
    (the suffixed right copy is dropped), or with ``fill_from_right`` takes
    the right value where the left one is NULL."""
    shared = [c for c in right.columns if c in left.columns and c != on]
    r = right.select(on, *[F.col(c).alias(c + suffix) if c in shared else F.col(c)
                           for c in right.columns if c != on])
    out = left.join(r, on=on, how="left")
    for c in shared:
        if fill_from_right:
            out = out.withColumn(c, F.coalesce(F.col(c), F.col(c + suffix)))
        out = out.drop(c + suffix)
    return out


def semi_join_values(df: DataFrame, column: str, allowed: DataFrame, allowed_col: str) -> DataFrame:
    """Rows whose ``column`` is in ``allowed`` (left semi join; the planner
    broadcasts a list that it knows to be small)."""
    return df.join(allowed, df[column] == allowed[allowed_col], "left_semi")


def series_with_hour(df: DataFrame, keys, ts: str, hour) -> DataFrame:
    """Rows of the series that have a row at exactly ``hour`` (left semi join on the
    keys, NULL keys are a series too). The hour is a filter on the inner scan; where
    the rows are many and the series few, Spark adds its Bloom filter of the keys
    to the outer scan."""
    found = df.where(F.col(ts) == ts_literal(hour)).select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    same = [df[k].eqNullSafe(found[f"_h_{k}"]) for k in keys]
    return df.join(found, reduce(lambda a, b: a & b, same), "left_semi")


def reverse_lookup(names: DataFrame, name_col: str, dim: DataFrame, dim_name: str,
                   dim_code: str, out: str = "code") -> DataFrame:
    """Name -> code through the dimension; unmatched names get NULL."""
    d = dim.select(F.col(dim_name).alias("_name"), F.col(dim_code).alias(out))
    return names.join(d, names[name_col] == d["_name"], "left").drop("_name")
