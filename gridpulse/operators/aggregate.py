"""Grouped aggregates: day totals, first non-null, sign splits, shares.

All of them are hash aggregates with map-side partial aggregation, so a hot
key is combined before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.scalars import col_of, on_day

__all__ = [
    "first_non_null", "day_totals", "multi_sum", "sign_split", "sign_split_exprs",
    "share_of_total", "zero_filled", "cumulative_by_day",
]


def first_non_null(df: DataFrame, keys, value: str, order, out: str | None = None) -> DataFrame:
    """First non-null ``value`` per group in ``order`` (ties broken by later order columns)."""
    order = [col_of(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    rank = F.struct(*order) if len(order) > 1 else order[0]
    key = F.when(F.col(value).isNotNull(), rank)
    return df.groupBy(*keys).agg(F.min_by(value, key).alias(out or value))


def day_totals(df: DataFrame, keys, ts: str, measure: str, day=None,
               out: str = "total", with_day: bool = False) -> DataFrame:
    """Sum of ``measure`` per ``keys`` (and calendar day) for one day or all days."""
    if day is not None:
        df = df.filter(on_day(ts, day))
    group = list(keys) + ([F.to_date(ts).alias("day")] if with_day else [])
    return df.groupBy(*group).agg(F.sum(measure).alias(out))


def multi_sum(df: DataFrame, cols, keys=()) -> DataFrame:
    """Sum of each column (per ``keys`` if given)."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def sign_split_exprs(value, imp: str = "import_mwh", exp: str = "export_mwh",
                     net: str | None = None, when: Column | None = None) -> list[Column]:
    """Sum of negatives (import), of positives (export) and optionally of all,
    each 0 when nothing qualifies; ``when`` restricts the rows counted."""
    v = col_of(value)
    gate = (lambda c: c) if when is None else (lambda c: c & when)
    out = [F.coalesce(F.sum(F.when(gate(v < 0), v)), F.lit(0)).alias(imp),
           F.coalesce(F.sum(F.when(gate(v > 0), v)), F.lit(0)).alias(exp)]
    if net:
        out.append(F.coalesce(F.sum(v if when is None else F.when(when, v)), F.lit(0)).alias(net))
    return out


def sign_split(df: DataFrame, keys, value: str, **kw) -> DataFrame:
    """Import (sum of negatives) and export (sum of positives) per ``keys``."""
    return df.groupBy(*keys).agg(*sign_split_exprs(value, **kw))


def share_of_total(df: DataFrame, keys, value: str, out: str = "share") -> DataFrame:
    """``|v| / sum(|v|)`` within ``keys``; NULL when the total is 0.

    Used after aggregation, where a group holds a handful of rows."""
    w = Window.partitionBy(*keys)
    total = F.sum(F.abs(F.col(value))).over(w)
    return df.withColumn(out, F.abs(F.col(value)) / F.nullif(total, F.lit(0)))


def zero_filled(dim: DataFrame, dim_key: str, agg: DataFrame, agg_key: str, value_cols) -> DataFrame:
    """Every dimension row with its aggregate, 0 when it has none (dimension on the left)."""
    if agg_key == dim_key:
        joined = dim.join(agg, on=dim_key, how="left")
    else:
        joined = dim.join(agg, dim[dim_key] == agg[agg_key], "left").drop(agg[agg_key])
    for c in value_cols:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return joined


def cumulative_by_day(daily: DataFrame, keys, day: str, cols, prefix: str = "cum_") -> DataFrame:
    """Running sums to each day per key (rows are daily aggregates: one per day)."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("*", *[F.sum(c).over(w).alias(prefix + c) for c in cols])
