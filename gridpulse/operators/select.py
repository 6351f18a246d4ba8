"""Projections and ordered picks: measure selection, first rows, first match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.scalars import col_of
from gridpulse.operators.aggregate import first_non_null
from gridpulse.operators.clean import require_columns

__all__ = ["select_measure", "first_rows", "first_match", "unpivot_measures"]


def select_measure(df: DataFrame, keys, measure: str, out: str = "value") -> DataFrame:
    """Keys plus one measure chosen by name at run time (checked at plan time)."""
    require_columns(df, list(keys) + [measure])
    return df.select(*keys, F.col(measure).alias(out))


def first_rows(df: DataFrame, order, n: int) -> DataFrame:
    """The first ``n`` rows in an explicit order (a top-k: each task keeps its
    own n best, then one small merge), never an arbitrary subset."""
    order = [col_of(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    return df.orderBy(*order).limit(n)


def first_match(df: DataFrame, keys, order, value: str, where=None) -> DataFrame:
    """Per group, ``value`` of the first row (in ``order``) matching ``where``."""
    rows = df if where is None else df.filter(where)
    return first_non_null(rows, keys, value, order)


def unpivot_measures(df: DataFrame, ids, measures, name: str = "measure",
                     value: str = "value", drop_nulls: bool = True) -> DataFrame:
    """Wide measure columns to ``(ids..., measure, value)`` rows."""
    long = df.unpivot(list(ids), list(measures), name, value)
    return long.filter(F.col(value).isNotNull()) if drop_nulls else long
