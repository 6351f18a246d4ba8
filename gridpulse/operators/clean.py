"""Load-time cleaning: time parsing and windows, null handling, renames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.jsonx import replace_exact
from gridpulse.functions.scalars import FIXED_PATTERN, in_time_range, parse_timestamp

__all__ = [
    "require_columns", "parse_time_window", "drop_incomplete", "replace_values",
    "distinct_values", "null_profile", "fill_constant", "to_kwh",
]


def require_columns(df: DataFrame, cols) -> None:
    """Plan-time column check (raises instead of returning an empty figure)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")


def parse_time_window(df: DataFrame, text_col: str, lo: str, hi: str,
                      pattern: str = "yyyy-MM-dd HH:mm:ss", out_col: str | None = None) -> DataFrame:
    """Drop NULL text, parse it strictly, keep ``lo <= ts <= hi`` (closed bounds).

    Unparsable text becomes NULL and so fails the range test.
    """
    out_col = out_col or text_col
    text, parsed = F.col(text_col), "__gp_parsed"
    kept = df.filter(text.isNotNull())
    told = kept.withColumn(parsed, parse_timestamp(text_col, pattern))
    if pattern == FIXED_PATTERN and _fixed(lo) and _fixed(hi):
        # The strict parse accepts only zero-padded 19-character text, whose
        # lexicographic order is time order: the range test runs on the text
        # itself, in the scan, and the parse only rejects bad text.
        told = told.filter((text >= F.lit(lo)) & (text <= F.lit(hi)) & F.col(parsed).isNotNull())
    else:
        told = told.filter(in_time_range(parsed, lo, hi))
    return told.withColumn(out_col, F.col(parsed)).drop(parsed)


def _fixed(bound) -> bool:
    import re
    return isinstance(bound, str) and re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", bound) is not None


def drop_incomplete(df: DataFrame, subset) -> DataFrame:
    """Rows whose ``subset`` columns are all non-NULL."""
    return df.na.drop(subset=list(subset))


def replace_values(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Whole-value replacement in one column (not substring)."""
    return df.withColumn(column, replace_exact(column, mapping))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(column).distinct()


def null_profile(df: DataFrame, cols) -> DataFrame:
    """One row per column: rows, NULL count, non-NULL count, and the sum with
    NULL read as 0 (one pass of conditional aggregates, then a tiny unpivot)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__null"),
                 F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"{c}__sum")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("measure"),
                     F.col(f"{c}__null").alias("n_null"),
                     F.col(f"{c}__sum").alias("sum_filled")) for c in cols]
    return (wide.select("n_rows", F.explode(F.array(*rows)).alias("r"))
                .select(F.col("r.measure").alias("measure"), "n_rows",
                        F.col("r.n_null").alias("n_null"),
                        (F.col("n_rows") - F.col("r.n_null")).alias("n_non_null"),
                        F.col("r.sum_filled").alias("sum_filled")))


def fill_constant(df: DataFrame, cols, value=0.0) -> DataFrame:
    """NULL in ``cols`` replaced by ``value`` (other columns untouched)."""
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def to_kwh(mwh_col: str, out: str = "total_kwh"):
    """MWh column times 1000, aliased."""
    return (F.col(mwh_col) * F.lit(1000)).alias(out)
