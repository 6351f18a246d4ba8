"""Frequency-domain smoothing of many hourly series at once.

Per series of length N: orthonormal DCT-II, keep the first ``floor(r * N)``
coefficients, inverse DCT, in O(N log N). Positions come from the two-level
scan (``series_positions``). Then:

* A series of at most ``points`` rows is one cell. Its rows go to numpy as an
  Arrow batch, two fast Fourier transforms smooth them, and the rows leave with
  one column more.
* A longer series is never in one task. Both transforms, with the kept
  coefficients k as their ends, are sums over ``exp(+-i pi n k / N)``, which the
  chirp identity ``2 n k = n^2 + k^2 - (k - n)^2`` turns into circular
  convolutions of a power of two M for any N. A convolution is a four-step
  transform: a cell (series, n mod M2) transforms its M1 numbers and applies the
  twiddle factors; one exchange transposes the matrix; a group of columns
  finishes the transform, multiplies by that of the chirp and starts the inverse;
  the exchange back brings each cell its numbers. The rows themselves are dealt
  to the cells once and take the result there. No cell, block or group holds
  more than about ``points`` numbers of a signal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.scalars import col_of
from gridpulse.operators.scan import CELL, PREFIX, series_positions

__all__ = ["smooth", "keep_count"]

SERIES, LANE = PREFIX + "series", PREFIX + "lane"
POINTS = 1 << 16  # of a cell; a year of hours has 8,760


def keep_count(n, ratio: float):
    """``int(n * ratio)`` as Spark computes it (double product, truncated)."""
    return F.floor(col_of(n).cast("double") * F.lit(float(ratio))).cast("int")


def _low_pass(x: np.ndarray, keep: int) -> np.ndarray:
    """Inverse DCT of the first ``keep`` DCT-II coefficients (orthonormal)."""
    n = len(x)
    if not keep:
        return np.zeros(n)
    spectrum = np.fft.fft(np.concatenate([x[::2], x[1::2][::-1]]))  # even places, then odd ones backwards
    turn = np.exp(-0.5j * np.pi * np.arange(n) / n)
    coefs = (spectrum * turn).real
    coefs[keep:] = 0.0
    mirrored = np.append(0.0, coefs[:0:-1])
    v = np.fft.ifft((coefs - 1j * mirrored) / turn).real
    out = np.empty(n)
    out[::2], out[1::2] = v[:(n + 1) // 2], v[(n + 1) // 2:][::-1]
    return out


def _chirp(n: np.ndarray, length: int, sign: int) -> np.ndarray:
    """exp(sign i pi n^2 / (2 length)), the square reduced as a whole number."""
    return np.exp(sign * 0.5j * np.pi * (n * n % (4 * length)) / length)


def _cells_of(length, keep, points: int):
    """``_Grid.m2`` of a length, as a column."""
    bits, least = F.length(F.bin(length + keep)), points.bit_length()
    return F.pow(F.lit(2.0), bits - F.least(bits, F.greatest(F.lit(least - 1), bits - F.lit(least - 1)))).cast("long")


class _Grid:
    """The M = M1 x M2 numbers of a convolution for a series of ``length``."""

    def __init__(self, length: int, keep: int, points: int):
        self.length, self.keep = length, keep
        bits = (length + keep).bit_length()
        cell = min(bits, max(points.bit_length() - 1, bits - points.bit_length() + 1))
        self.m, self.m1, self.m2 = 1 << bits, 1 << cell, 1 << (bits - cell)
        self.width = max(1, points // self.m2)  # columns of a group

    def twiddle(self, n2, k1, sign: int) -> np.ndarray:
        return np.exp(sign * 2j * np.pi * (n2 * k1 % self.m) / self.m)

    def places(self, n2: int) -> np.ndarray:
        return n2 + self.m2 * np.arange(self.m1)

    def spread(self, signal: np.ndarray, n2: int, ahead: int, behind: int, sign: int):
        """First half of the transforms of a cell's signal and of the chirp that it
        is convolved with, whose places run from ``-behind + 1`` to ``ahead - 1``;
        as (lane, parts) for every group of columns."""
        at = self.places(n2)
        kernel = np.where(at < ahead, _chirp(at, self.length, sign), 0) + np.where(at > self.m - behind, _chirp(at - self.m, self.length, sign), 0)
        turn = self.twiddle(n2, np.arange(self.m1), -1)
        a, b = np.fft.fft(signal) * turn, np.fft.fft(kernel) * turn
        for lane in range(0, self.m1, self.width):
            cut = slice(lane, lane + self.width)
            yield lane // self.width, (a[cut], b[cut])


def _loose(kind: pa.DataType) -> pa.DataType:
    """The type with nullable fields at every depth, as a schema text declares it."""
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _loose(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(_loose(kind.value_type))
    return kind


def _columns(table: pa.Table, names: list[str]) -> pa.Table:
    table = table.select(names)
    return table.cast(pa.schema([pa.field(f.name, _loose(f.type)) for f in table.schema]))


def _pieces(series: pa.ChunkedArray, rows: list[tuple[int, int, tuple]]) -> pa.Table:
    """A table of (series, lane, n2, numbers): complex arrays as pairs of doubles."""
    flat = [np.concatenate(parts).view(np.float64) for _, _, parts in rows]
    offsets = np.append(0, np.cumsum([len(x) for x in flat])).astype(np.int32)
    numbers = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0), *flat])))
    series = series.slice(0, 1).cast(_loose(series.type)).combine_chunks()
    return pa.table([series.take(pa.array(np.zeros(len(rows), np.int64))), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()), numbers], names=[SERIES, LANE, "n2", "numbers"])


def _complex(table: pa.Table, order: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows' arrays in the order of a column, with that column."""
    table = table.sort_by(order)
    numbers = table.column("numbers").combine_chunks()
    return table.column(order).to_numpy(), [x.values.to_numpy().view(np.complex128) for x in numbers]


def _bounded(df: DataFrame, keys: list, order: list, raw: str, out: str, pos: str, length: str,
             keep_ratio: float, max_points: int) -> DataFrame:
    """Series of at most ``max_points`` rows: each is ordered and smoothed whole."""
    columns, by = df.columns, [PREFIX + f"by{i}" for i in range(len(order))]
    df = df.withColumns({name: col_of(o) for name, o in zip(by, order, strict=True)})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in by)

    def whole(table: pa.Table) -> pa.Table:
        n = table.num_rows
        if n > max_points:
            raise ValueError(f"a series has {n} rows, more than max_points = {max_points}")
        at = pa.compute.sort_indices(table, [(name, "ascending") for name in by], null_placement="at_start").to_numpy().astype(np.int64)
        place, smoothed = np.empty(n, np.int64), np.empty(n)
        place[at] = np.arange(n)
        smoothed[at] = _low_pass(table.column(raw).to_numpy()[at], int(n * keep_ratio))
        table = _columns(table, columns).append_column(pos, pa.array(place))
        return table.append_column(length, pa.array(np.full(n, n))).append_column(out, pa.array(smoothed))

    return df.groupBy(*keys).applyInArrow(whole, schema + f", `{pos}` long, `{length}` long, `{out}` double")


def smooth(df: DataFrame, keys, order, value: str, keep_ratio: float = 0.02, chunk=None,
           fill: float = 0.0, raw_out: str = "raw", out: str = "smoothed",
           pos_out: str = "pos", len_out: str = "n_points",
           materialize: bool = False, points: int = POINTS, max_points: int | None = None) -> DataFrame:
    """Low-pass each series. NULL values read as ``fill`` first. A series
    with ``floor(ratio * N) = 0`` kept coefficients smooths to all zeros.

    ``chunk`` (a Column that does not decrease along ``order``, by default
    calendar months or key ranges) bounds the rows of a position window, and
    ``points`` those of a smoothing cell. ``materialize=True`` checkpoints the
    positioned rows once to the shared checkpoint folder instead of computing
    them for each pass (worth it for very large inputs).

    ``max_points`` is a bound of a series' rows that the caller can prove, such as
    the hours of a calendar range. Within ``points`` it makes every series one
    cell, ordered there: one exchange and no position windows. A series that
    breaks the bound raises an error. Without it any length is planned for."""
    keys = list(keys)
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    base = df.withColumn(raw_out, F.coalesce(F.col(value).cast("double"), F.lit(float(fill))))
    if max_points is not None and max_points <= points:
        return _bounded(base, keys, order, raw_out, out, pos_out, len_out, keep_ratio, max_points)
    rows = series_positions(base, keys, order, chunk, pos_out, len_out, keep_cell=True)
    rows = rows.withColumn(SERIES, F.col(f"{CELL}.series")).drop(CELL)
    if materialize:
        from gridpulse.session import materialize as _materialize
        rows = _materialize(rows)
    columns = [c for c in rows.columns if c != SERIES]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + f", `{out}` double"

    def kept(n: int) -> int:
        return int(n * keep_ratio)

    def whole(table: pa.Table) -> pa.Table:
        at = table.column(pos_out).to_numpy()
        x = np.empty(len(at))
        x[at] = table.column(raw_out).to_numpy()
        return _columns(table, columns).append_column(out, pa.array(_low_pass(x, kept(len(x)))[at]))

    length = F.col(len_out)
    short = rows.where(length <= points).groupBy(SERIES).applyInArrow(whole, schema)

    # Longer series: cells by the position modulo M2.
    dealt = rows.where(length > points).withColumn(LANE, F.pmod(F.col(pos_out), _cells_of(length, keep_count(length, keep_ratio), points)))
    piece = f"`{SERIES}` {types[SERIES]}, `{LANE}` long, n2 long, n long, numbers array<double>"

    def sized(table: pa.Table, n: int) -> pa.Table:
        return table.add_column(3, "n", pa.array(np.full(table.num_rows, n)))

    def forward(table: pa.Table) -> pa.Table:
        n, n2 = table.column(len_out)[0].as_py(), table.column(LANE)[0].as_py()
        grid, at = _Grid(n, kept(n), points), table.column(pos_out).to_numpy()
        signal = np.zeros(grid.m1, complex)
        signal[at // grid.m2] = table.column(raw_out).to_numpy() * _chirp(at, n, -1)
        return sized(_pieces(table.column(SERIES),
                             [(lane, n2, parts) for lane, parts in grid.spread(signal, n2, grid.keep, n, 1)]), n)

    def multiply(table: pa.Table) -> pa.Table:
        n, lane = table.column("n")[0].as_py(), table.column(LANE)[0].as_py()
        grid = _Grid(n, kept(n), points)
        n2, numbers = _complex(table, "n2")
        both = np.array(numbers)
        width = both.shape[1] // 2
        columns = lane * grid.width + np.arange(width)
        product = np.fft.fft(both[:, :width], axis=0) * np.fft.fft(both[:, width:], axis=0)
        back = np.fft.ifft(product, axis=0) * grid.twiddle(n2[:, None], columns[None, :], 1)
        # the lane of a piece becomes its cell, and its place there the group of columns
        return sized(_pieces(table.column(SERIES), [(k, lane, (row,)) for k, row in zip(n2.tolist(), back, strict=True)]), n)

    def convolved(table: pa.Table) -> tuple[_Grid, int, np.ndarray]:
        n, n2 = table.column("n")[0].as_py(), table.column(LANE)[0].as_py()
        return _Grid(n, kept(n), points), n2, np.fft.ifft(np.concatenate(_complex(table, "n2")[1]))

    def turned(table: pa.Table) -> pa.Table:
        grid, n2, found = convolved(table)
        n, k = grid.length, grid.places(n2)
        half = np.exp(0.5j * np.pi * k / n)
        coefs = (found * _chirp(k, n, -1) / half).real * np.where(k == 0, 1.0, 2.0) / n
        signal = np.where(k < grid.keep, coefs * half * _chirp(k, n, 1), 0)
        return sized(_pieces(table.column(SERIES),
                             [(lane, n2, parts) for lane, parts in grid.spread(signal, n2, n, grid.keep, -1)]), n)

    def finish(cell: pa.Table, pieces: pa.Table) -> pa.Table:
        at = cell.column(pos_out).to_numpy()
        smoothed = np.zeros(len(at))
        if pieces.num_rows:
            grid, _, found = convolved(pieces)
            smoothed = (found[at // grid.m2] * _chirp(at, grid.length, 1)).real
        return _columns(cell, columns).append_column(out, pa.array(smoothed))

    by = (SERIES, LANE)
    some = dealt.where(keep_count(length, keep_ratio) > 0)
    pieces = some.groupBy(*by).applyInArrow(forward, piece).groupBy(*by).applyInArrow(multiply, piece)
    pieces = pieces.groupBy(*by).applyInArrow(turned, piece).groupBy(*by).applyInArrow(multiply, piece)
    long = dealt.groupBy(*by).cogroup(pieces.groupBy(*by)).applyInArrow(finish, schema)
    return short.unionByName(long)
