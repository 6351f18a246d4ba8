"""Scalar column expressions: dates, maths, formatting, conditionals.

Each helper returns a ``Column`` built from built-in Spark functions, so it
stays inside whole-stage codegen and never leaves the JVM.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "ts_literal", "date_literal", "on_day", "up_to_day",
    "in_time_range", "parse_timestamp", "floor_ntz", "lenient_timestamp", "day_number_to_date",
    "iso_hour", "wall_clock_text", "short_date", "month_day_label", "nan_to_null", "marker_size",
    "abs_sum_size", "rescale", "palette_index", "clip", "truncate_to_int",
    "fmt2", "level", "first_set", "category_lookup", "label_lines", "fill_template",
]

_SAFE_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def col_of(c) -> Column:
    """A Column from a name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def _ts_text(value) -> str:
    if isinstance(value, _dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, _dt.date):
        return value.strftime("%Y-%m-%d 00:00:00")
    return str(value)


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal (folded by Catalyst, pushable to parquet)."""
    return F.expr(f"TIMESTAMP_NTZ '{_ts_text(value)}'")


def date_literal(value) -> Column:
    """A DATE literal."""
    text = value.isoformat() if isinstance(value, (_dt.date, _dt.datetime)) else str(value)
    return F.expr(f"DATE '{text[:10]}'")


def on_day(ts, day) -> Column:
    """Calendar-day equality as a half-open range, so it reaches the scan."""
    d = _dt.date.fromisoformat(str(day)[:10])
    return (col_of(ts) >= ts_literal(d)) & (col_of(ts) < ts_literal(d + _dt.timedelta(days=1)))


def up_to_day(ts, day) -> Column:
    """``to_date(ts) <= day`` as a range predicate."""
    d = _dt.date.fromisoformat(str(day)[:10])
    return col_of(ts) < ts_literal(d + _dt.timedelta(days=1))


def in_time_range(ts, lo, hi) -> Column:
    """Closed range ``lo <= ts <= hi`` (e.g. hi = '... 23:59:59')."""
    return (col_of(ts) >= ts_literal(lo)) & (col_of(ts) <= ts_literal(hi))


def parse_timestamp(text, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Strict pattern parse straight to TIMESTAMP_NTZ (the wall clock, in any
    session zone); malformed text gives NULL. Text of the fixed pattern's shape is
    cast; for other patterns ``try_to_timestamp`` only validates, so that the ANSI
    parse never sees bad text."""
    t = col_of(text)
    if pattern == FIXED_PATTERN:
        return F.when(F.regexp_like(t, F.lit(FIXED_SHAPE)), t.try_cast("timestamp_ntz"))
    return F.when(F.try_to_timestamp(t, F.lit(pattern)).isNotNull(),
                  F.to_timestamp_ntz(t, F.lit(pattern)))


FIXED_PATTERN = "yyyy-MM-dd HH:mm:ss"
FIXED_SHAPE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2}|[+-]\d{2})\s*$"


def utc_wall_clock(instant) -> Column:
    """The UTC wall clock of a zoned TIMESTAMP, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_of(instant)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def lenient_timestamp(c, kind: str = "string") -> Column:
    """Coerce to the UTC wall clock as TIMESTAMP_NTZ; bad values give NULL.

    ``kind`` is the declared type: a zoned TIMESTAMP is converted to UTC, text
    with a zone suffix too; TIMESTAMP_NTZ and text without one already are UTC."""
    t = col_of(c)
    if kind == "timestamp":
        return utc_wall_clock(t)
    if kind == "string":
        zoned = F.regexp_like(t, F.lit(r"\d{2}:\d{2}.*" + ZONE_SUFFIX))
        return F.when(zoned, utc_wall_clock(t.try_cast("timestamp"))).otherwise(t.try_cast("timestamp_ntz"))
    return t.try_cast("timestamp_ntz")


def floor_ntz(ts, unit: str = "hour") -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour / day / month without passing
    through the session time zone (``date_trunc`` returns a zoned TIMESTAMP)."""
    t = col_of(ts)
    zero = F.lit(0)
    if unit == "hour":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), zero,
                                    zero.cast("decimal(8,6)"))
    if unit == "day":
        return F.to_date(t).cast("timestamp_ntz")
    if unit == "month":
        return F.trunc(F.to_date(t), "month").cast("timestamp_ntz")
    raise ValueError(f"unsupported unit {unit!r}")


def day_number_to_date(day_number, base: str) -> Column:
    """Day number d (1-based) after ``base``: base + (d - 1)."""
    return F.date_add(date_literal(base), (col_of(day_number) - 1).cast("int"))


def wall_clock_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a TIMESTAMP_NTZ (NULL stays NULL).

    Casting TIMESTAMP_NTZ to text prints the stored wall clock without any
    zone, unlike ``date_format`` (which goes through the session zone, so
    wall clocks inside a daylight-saving gap would shift); the fraction, if
    any, is cut off."""
    return F.substring(col_of(ts).cast("timestamp_ntz").cast("string"), 1, 19)


def iso_hour(ts) -> Column:
    """ISO text ``yyyy-MM-ddTHH:mm:ss`` of a TIMESTAMP_NTZ (NULL stays NULL)."""
    text = wall_clock_text(ts)
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def short_date(d) -> Column:
    """``yyyy-MM-dd`` of a DATE or TIMESTAMP_NTZ (NULL stays NULL)."""
    return F.to_date(col_of(d)).cast("string")


def month_day_label(d) -> Column:
    """``Month dd`` label of a date (e.g. ``March 02``)."""
    return F.date_format(col_of(d), "MMMM dd")


def nan_to_null(c) -> Column:
    """NaN as NULL (DOUBLE)."""
    c = col_of(c).cast("double")
    return F.when(~F.isnan(c), c)


def marker_size(v, factor: float) -> Column:
    """``ln(sqrt(v) + 1) * factor``; negative input gives NULL instead of NaN."""
    v = col_of(v)
    return F.when(v >= 0, F.log(F.sqrt(v) + F.lit(1.0)) * F.lit(float(factor)))


def abs_sum_size(a, b, factor: float) -> Column:
    """``ln(|a + b| + 1) * factor``."""
    return F.log(F.abs(col_of(a) + col_of(b)) + F.lit(1.0)) * F.lit(float(factor))


def rescale(x, lo, hi, out_lo: float = 0.0, out_hi: float = 1.0) -> Column:
    """Linear map of ``[lo, hi]`` onto ``[out_lo, out_hi]`` with clamping.

    ``x >= hi`` is tested first so a degenerate range (lo == hi) maps to the
    upper end, as piecewise-linear interpolation does.
    """
    x, lo, hi = col_of(x), col_of(lo), col_of(hi)
    span = F.lit(float(out_hi) - float(out_lo))
    return (F.when(x >= hi, F.lit(float(out_hi)))
             .when(x <= lo, F.lit(float(out_lo)))
             .otherwise(F.lit(float(out_lo)) + (x - lo) * span / (hi - lo)))


def truncate_to_int(x) -> Column:
    """Truncating cast; NaN or out-of-range gives NULL rather than an error."""
    return _try_int(col_of(x))


def _try_int(c: Column) -> Column:
    c = c.cast("double")
    return F.when(~F.isnan(c), c).try_cast("int")


def clip(x, lo, hi) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (least/greatest alone skip NULLs)."""
    x = col_of(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def palette_index(scale, n_colors: int, clip_range: bool = False) -> Column:
    """Bucket index ``int(scale * (n - 1))`` into an n-step palette."""
    idx = _try_int(col_of(scale) * F.lit(float(n_colors - 1)))
    return clip(idx, 0, n_colors - 1) if clip_range else idx


def fmt2(x) -> Column:
    """Fixed two-decimal text, as ``f"{x:.2f}"`` (NULL stays NULL)."""
    x = col_of(x).cast("double")
    return F.when(x.isNotNull(), F.format_string("%.2f", x))


def level(current, maximum, thresholds=(0.8, 0.95), names=("green", "yellow", "red")) -> Column:
    """Threshold level: below t1*max -> names[0], below t2*max -> names[1], else names[2]."""
    current, maximum = col_of(current), col_of(maximum)
    return (F.when(current < F.lit(thresholds[0]) * maximum, F.lit(names[0]))
             .when(current < F.lit(thresholds[1]) * maximum, F.lit(names[1]))
             .otherwise(F.lit(names[2])))


def first_set(flags: list[tuple[Column, str]], fallback) -> Column:
    """First flag that is set wins, else the fallback (CND1)."""
    expr = None
    for flag, name in flags:
        expr = F.when(flag, F.lit(name)) if expr is None else expr.when(flag, F.lit(name))
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return fb if expr is None else expr.otherwise(fb)


def category_lookup(c, mapping: dict, default=None) -> Column:
    """Map a category to a value via an ordered CASE (small fixed mappings)."""
    c = col_of(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    dflt = F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def label_lines(parts: list[tuple[str, Column]], optional: list[tuple[str, Column]] = (),
                sep: str = "<br>") -> Column:
    """Multi-line label ``"prefix: value"``; optional parts vanish when NULL.

    Non-optional NULLs print as an empty string.
    """
    pieces = []
    for prefix, value in parts:
        text = F.coalesce(value.cast("string"), F.lit(""))
        pieces.append(F.concat(F.lit(prefix), text) if prefix else text)
    body = F.concat_ws(sep, *pieces)
    for prefix, value in optional:
        body = F.concat(body, F.lit(sep),
                        F.when(value.isNotNull(), F.concat(F.lit(prefix), value.cast("string")))
                         .otherwise(F.lit("")))
    return body


_SLOT = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def fill_template(fmt: str, **values) -> Column:
    """A text column from a ``{name}`` template: literal pieces and the given
    Columns (or plain values) concatenated in order. NULL values print as
    ``None``, as the formatted labels do."""
    parts, pos = [], 0
    for m in _SLOT.finditer(fmt):
        if m.start() > pos:
            parts.append(F.lit(fmt[pos:m.start()]))
        v = values[m.group(1)]
        c = v if isinstance(v, Column) else F.lit(v)
        parts.append(F.coalesce(c.cast("string"), F.lit("None")))
        pos = m.end()
    if pos < len(fmt):
        parts.append(F.lit(fmt[pos:]))
    return F.concat(*parts) if parts else F.lit("")
