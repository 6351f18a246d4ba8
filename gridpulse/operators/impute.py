"""Per-series imputation: linear interpolation by row position, then forward
fill, then backward fill (leading gaps take the first value, trailing gaps the
last, inner gaps a straight line between neighbours).

Only the named value columns are filled; keys and time are never touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.scalars import col_of, nan_to_null
from gridpulse.operators.scan import CELL, PREFIX, before_chunk, with_cells

__all__ = ["fill_gaps"]

RN, OFF = PREFIX + "rn", PREFIX + "off"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lead_non_null(sql_expr: str):
    """``lead(x, 1) IGNORE NULLS``: the next non-null value after this row."""
    return F.expr(f"lead({sql_expr}, 1) IGNORE NULLS")


def fill_gaps(df: DataFrame, keys, order, values, chunk=None) -> DataFrame:
    """Interpolate -> ffill -> bfill each of ``values`` within each series.

    ``keys`` identify a series, ``order`` (columns or Columns) orders it and
    must be unique within a series. ``chunk`` (a Column such as
    ``floor_ntz(ts, "month")``, monotone in ``order``; by default months or key
    ranges) spreads a long or hot series over many tasks.
    """
    keys, values = list(keys), list(values)
    order = [col_of(o) for o in order]
    cols = df.columns
    # NaN counts as missing, as in pandas
    df = df.select(*[nan_to_null(F.col(c)).alias(c) if c in values else F.col(c) for c in cols])
    df = with_cells(df, keys, order, chunk)
    w = Window.partitionBy(CELL).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # one sort per cell: the previous non-null comes from a running frame, the
    # next one from lead(...) IGNORE NULLS (both linear)
    local = df.withColumn(RN, F.row_number().over(w))
    sel = [F.col(c) for c in local.columns]
    for i, v in enumerate(values):
        q = _quote(v)
        # value and position travel together: one window function per direction
        pair = F.when(F.col(v).isNotNull(), F.struct(F.col(v).alias("v"), F.col(RN).alias("p")))
        sel += [F.last(pair, True).over(upto).alias(f"{PREFIX}prev{i}"),
                _lead_non_null(f"CASE WHEN {q} IS NOT NULL THEN named_struct('v', {q}, 'p', {RN}) END")
                .over(w).alias(f"{PREFIX}next{i}")]
    filled = local.select(*sel)
    out = filled.join(_carry(local, values), CELL, "left")

    at = (F.col(OFF) + F.col(RN)).cast("double")
    result = []
    for i, v in enumerate(values):
        here = F.when(F.col(v).isNotNull(), F.struct(F.col(v).alias("v"), F.col(RN).alias("p")))
        prev, nxt = F.col(f"{PREFIX}prev{i}"), F.coalesce(here, F.col(f"{PREFIX}next{i}"))
        before, after = F.col(f"{PREFIX}before{i}"), F.col(f"{PREFIX}after{i}")
        pv = F.when(prev.isNotNull(), prev["v"]).otherwise(before["v"]).cast("double")
        pp = F.when(prev.isNotNull(), F.col(OFF) + prev["p"]).otherwise(before["p"]).cast("double")
        nv = F.when(nxt.isNotNull(), nxt["v"]).otherwise(after["v"]).cast("double")
        np_ = F.when(nxt.isNotNull(), F.col(OFF) + nxt["p"]).otherwise(after["p"]).cast("double")
        interp = F.when(pp.isNotNull() & np_.isNotNull(), (nv - pv) / F.nullif(np_ - pp, F.lit(0.0)) * (at - pp) + pv)
        result.append(F.coalesce(F.col(v).cast("double"), interp, pv, nv).alias(v))
    return out.select(*[c for c in cols if c not in values], *result).select(*cols)


def _carry(numbered: DataFrame, values) -> DataFrame:
    """Per cell: row offset and the nearest non-null value (with its position in
    the series) in earlier and in later chunks.

    ``numbered`` holds the dealt rows with their row number in the cell, so the
    summary is an aggregate without a further shuffle of rows."""
    count = PREFIX + "cnt"
    aggs = [F.max(RN).alias(count)]
    for i, v in enumerate(values):
        # structs order by their first field: the position
        pair = F.when(F.col(v).isNotNull(), F.struct(F.col(RN).alias("p"), F.col(v).alias("v")))
        aggs += [F.min(pair).alias(f"{PREFIX}first{i}"), F.max(pair).alias(f"{PREFIX}last{i}")]
    summary = numbered.groupBy(CELL).agg(*aggs)
    later = (Window.partitionBy(f"{CELL}.series").orderBy(F.col(f"{CELL}.chunk").desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.withColumn(OFF, F.coalesce(F.sum(count).over(before_chunk()), F.lit(0)).cast("long"))

    def placed(name):
        c = F.col(name)
        return F.when(c.isNotNull(), F.struct((F.col(OFF) + c["p"]).alias("p"), c["v"].alias("v")))

    return summary.select(CELL, OFF, *[
        c for i in range(len(values))
        for c in (F.last(placed(f"{PREFIX}last{i}"), True).over(before_chunk()).alias(f"{PREFIX}before{i}"),
                  F.last(placed(f"{PREFIX}first{i}"), True).over(later).alias(f"{PREFIX}after{i}"))])
