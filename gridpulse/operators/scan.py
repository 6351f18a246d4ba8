"""Two-level ordered scans over long series.

A window ``partitionBy(series).orderBy(t)`` puts a whole series in one task,
so one hot series would bound the job. Here the rows are dealt once by their
cell, which is (series, chunk), e.g. a calendar month of a series: the windows
run inside a cell, a small summary with one row per cell carries state across
chunk borders (windowed per series), and it is joined back on the cell, whose
clustering the rows already have.

The cell is a struct, never NULL itself, so rows with NULL keys are a series
of their own under plain equality. Internal columns start with ``__gp_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.scalars import col_of, floor_ntz

__all__ = ["with_cells", "with_chunks", "splitters", "series_positions", "running_extrema", "null_safe_join", "CELL"]

PREFIX = "__gp_"
CELL = PREFIX + "cell"
SAMPLE = 1 << 14  # keys that the splitters are chosen from, and the most cells
FAN = 128  # splitters below one head
CELL_ROWS = 1024  # rows that a cell should have


def splitters(df: DataFrame, order, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row (heads, splitters): keys that cut the rows into ranges of about equal
    counts, about one for ``cell_rows`` rows, at most ``sample``.

    The sample has the row of the least hash of each of ``sample`` hash buckets, a
    partial aggregation of a fixed size. It holds whole keys, so that texts with one
    long prefix are told apart, and does not depend on how the rows are dealt."""
    hashed = F.xxhash64("k")
    picked = (df.select(F.struct(*[col_of(o).alias(f"o{i}") for i, o in enumerate(order)]).alias("k"))
              .groupBy(F.pmod(hashed, F.lit(sample)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min_by("k", F.struct(hashed, "k")).alias("k")))
    keys = picked.agg(F.sort_array(F.collect_list("k")).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    m, cells = F.size("keys"), F.col("cells")
    keys = keys.withColumn("cells", F.least(m.cast("long"), F.ceil(F.col("n") / F.lit(cell_rows))).cast("int"))
    cuts = F.when(cells > 1, F.transform(F.sequence(F.lit(1), cells - 1), lambda i: F.element_at("keys", (i * F.size("keys") / cells).cast("int") + 1)))
    cuts = F.coalesce(cuts, F.slice("keys", 1, 0)).alias("cuts")
    keys = keys.select(cuts)
    heads = F.filter("cuts", lambda _, i: i % FAN == 0)
    return keys.select(F.struct(heads.alias("heads"), F.col("cuts")).alias("s"))


def with_chunks(df: DataFrame, order, out: str, **limits: int) -> DataFrame:
    """Add chunks for an order without given ones: calendar months if it starts with
    a time, else contiguous ranges of the full order key, whatever its types, between
    sampled splitters that are read as a scalar subquery."""
    first = col_of(order[0])
    if df.select(first).dtypes[0][1] in ("timestamp_ntz", "timestamp", "date"):
        return df.withColumn(out, floor_ntz(first, "month"))
    held, key = PREFIX + "splitters", PREFIX + "key"
    df = df.withColumn(held, splitters(df, order, **limits).scalar())
    df = df.withColumn(key, F.struct(*[col_of(o).alias(f"o{i}") for i, o in enumerate(order)]))
    not_after = lambda keys: F.size(F.filter(keys, lambda k: k <= F.col(key)))
    head = PREFIX + "head"
    df = df.withColumn(head, not_after(F.col(held)["heads"]))
    inner = not_after(F.slice(F.col(held)["cuts"], (F.col(head) - 1) * FAN + 1, F.lit(FAN)))
    return df.withColumn(out, F.when(F.col(head) > 0, (F.col(head) - 1) * FAN + inner).otherwise(F.lit(0))).drop(held, key, head)


def with_cells(df: DataFrame, keys, order, chunk=None) -> DataFrame:
    """Add the cell column and deal the rows by it: the one shuffle of a scan.
    ``chunk`` must not decrease along the order."""
    if clash := [c for c in df.columns if c.startswith(PREFIX)]:
        raise ValueError(f"column names starting with {PREFIX} are reserved: {clash}")
    name = PREFIX + "chunk"
    df = with_chunks(df, order, name) if chunk is None else df.withColumn(name, col_of(chunk))
    series = F.struct(F.lit(0).alias("s"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return df.withColumn(CELL, F.struct(series.alias("series"), F.col(name).alias("chunk"))).drop(name).repartition(CELL)


def before_chunk():
    """Earlier chunks of the same series, for a frame with one row per cell."""
    return (Window.partitionBy(f"{CELL}.series").orderBy(f"{CELL}.chunk")
            .rowsBetween(Window.unboundedPreceding, -1))


def null_safe_join(left: DataFrame, summary: DataFrame, on) -> DataFrame:
    """Left join of per-group summaries back onto the rows; NULL keys are a
    group of their own."""
    on = list(on)
    right = summary.select(*[F.col(c).alias(f"_j_{c}") for c in on],
                           *[c for c in summary.columns if c not in on])
    cond = None
    for c in on:
        t = left[c].eqNullSafe(right[f"_j_{c}"])
        cond = t if cond is None else cond & t
    return left.join(right, cond, "left").drop(*[f"_j_{c}" for c in on])


def series_positions(df: DataFrame, keys, order, chunk=None, pos: str = "_pos", length: str = "_len",
                     keep_cell: bool = False) -> DataFrame:
    """Add a 0-based row position within each series (ordered by ``order``)
    and the series length, without a per-series single-task window."""
    rn, off = PREFIX + "rn", PREFIX + "off"
    cells = with_cells(df, keys, order, chunk)
    local = cells.withColumn(rn, F.row_number().over(Window.partitionBy(CELL).orderBy(*[col_of(o) for o in order])))
    # counts come from the dealt rows, so the summary needs no further shuffle
    counts = local.groupBy(CELL).agg(F.max(rn).cast("long").alias(PREFIX + "cnt"))
    offsets = counts.select(
        CELL, F.coalesce(F.sum(PREFIX + "cnt").over(before_chunk()), F.lit(0)).alias(off),
        F.sum(PREFIX + "cnt").over(Window.partitionBy(f"{CELL}.series")).alias(length))
    out = local.join(offsets, CELL, "left").withColumn(pos, (F.col(off) + F.col(rn) - 1).cast("long")).drop(off, rn)
    return out if keep_cell else out.drop(CELL)


def running_extrema(df: DataFrame, order, value: str, chunk=None, keys=(),
                    lo: str = "_run_lo", hi: str = "_run_hi") -> DataFrame:
    """Running min and max of ``value`` over rows seen so far in ``order``
    (current row included, NULLs skipped), optionally per ``keys``."""
    order = [col_of(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    so_far = Window.partitionBy(CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [PREFIX + n for n in ("llo", "lhi", "clo", "chi", "plo", "phi")]
    llo, lhi, clo, chi, plo, phi = names
    local = with_cells(df, list(keys), order, chunk).withColumns(
        {llo: F.min(value).over(so_far), lhi: F.max(value).over(so_far)})
    per_cell = local.groupBy(CELL).agg(F.min(value).alias(clo), F.max(value).alias(chi))
    carried = per_cell.select(CELL, F.min(clo).over(before_chunk()).alias(plo), F.max(chi).over(before_chunk()).alias(phi))
    out = local.join(carried, CELL, "left")
    return out.withColumn(lo, F.least(llo, plo)).withColumn(hi, F.greatest(lhi, phi)).drop(CELL, llo, lhi, plo, phi)
