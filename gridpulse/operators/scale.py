"""Scaling: running and grouped min-max rescale, z-score sizes, palette buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.scalars import palette_index, rescale
from gridpulse.operators.scan import null_safe_join, running_extrema

__all__ = ["running_rescale", "group_rescale", "zscore_size"]


def running_rescale(df: DataFrame, order, value: str, out: str = "scale",
                    out_lo: float = 0.0, out_hi: float = 1.0, chunk=None, keys=(),
                    n_colors: int | None = None, index_out: str = "color_index") -> DataFrame:
    """Rescale each row by the min and max of the rows seen so far in ``order``.

    The running bounds come from the two-level scan (key ranges where no
    ``chunk`` is given), so no single task holds all rows."""
    df = running_extrema(df, order, value, chunk=chunk, keys=keys)
    df = df.withColumn(out, rescale(value, "_run_lo", "_run_hi", out_lo, out_hi))
    if n_colors:
        df = df.withColumn(index_out, palette_index(out, n_colors))
    return df.drop("_run_lo", "_run_hi")


def group_rescale(df: DataFrame, keys, value: str, out: str = "scale",
                  out_lo: float = 0.0, out_hi: float = 1.0, n_colors: int | None = None,
                  index_out: str = "color_index", clip_index: bool = True,
                  bounded_keys: bool = False) -> DataFrame:
    """Rescale by min and max within ``keys`` (all rows when ``keys`` is empty).

    The bounds are a partial aggregate joined back: no single-partition
    window. With no keys the bounds are one row, so they are broadcast; with
    ``bounded_keys`` (e.g. calendar days: one row per day, whatever the data
    volume) they are broadcast too, so the rows are never shuffled for it."""
    keys = list(keys)
    if keys:
        bounds = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        if bounded_keys:
            bounds = F.broadcast(bounds)
        out_df = null_safe_join(df, bounds, keys)
    else:
        bounds = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")) \
                   .withColumn("_one", F.lit(1))
        out_df = df.withColumn("_one", F.lit(1)).join(F.broadcast(bounds), on="_one").drop("_one")
    out_df = out_df.withColumn(out, rescale(value, "_lo", "_hi", out_lo, out_hi))
    if n_colors:
        out_df = out_df.withColumn(index_out, palette_index(out, n_colors, clip_range=clip_index))
    return out_df.drop("_lo", "_hi")


def zscore_size(df: DataFrame, keys, value: str, factor: float = 1.0, out: str = "z_size",
                with_stats: bool = True, bounded_keys: bool = False) -> DataFrame:
    """``|v - mean| / std * factor`` within ``keys`` (sample std; NULL when std is
    0 or undefined). Stats are a partial aggregate joined back on ``keys``;
    with ``bounded_keys`` (e.g. days of a fixed list of stations) they are
    broadcast, so a station with many rows is not shuffled to one task."""
    keys = list(keys)
    stats = df.groupBy(*keys).agg(F.sum(value).alias("day_sum"), F.avg(value).alias("mean"),
                                  F.stddev_samp(value).alias("std"))
    if bounded_keys:
        stats = F.broadcast(stats)
    out_df = null_safe_join(df, stats, keys)  # a NULL key is a group too
    out_df = out_df.withColumn(
        out, F.abs(F.col(value) - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
        * F.lit(float(factor)))
    return out_df if with_stats else out_df.drop("day_sum", "mean", "std")
