"""Property tests (hypothesis): small random inputs, invariants that must hold."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridpulse.functions import rescale
from gridpulse.operators.aggregate import sign_split
from gridpulse.operators.impute import fill_gaps

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=25)


@SETTINGS
@given(xs=values)
def test_imputation_matches_pandas_and_keeps_values(spark, xs):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(xs)], "s int, t int, v double")
    got = [r[0] for r in fill_gaps(df, ["s"], ["t"], ["v"]).orderBy("t").select("v").collect()]
    exp = pd.Series(xs, dtype=float).interpolate(method="linear").ffill().bfill().tolist()
    for g, e, x in zip(got, exp, xs):
        if x is not None:
            assert g == x
        if e is None or (isinstance(e, float) and math.isnan(e)):
            assert g is None
        else:
            assert abs(g - e) <= 1e-9 * max(1.0, abs(e))


@SETTINGS
@given(xs=st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=30))
def test_sign_split_sums_to_net(spark, xs):
    df = spark.createDataFrame([(v,) for v in xs], "v double")
    r = sign_split(df, [], "v", net="net").first()
    assert r["import_mwh"] <= 0 <= r["export_mwh"]
    assert abs(r["import_mwh"] + r["export_mwh"] - r["net"]) <= 1e-9 * max(1.0, sum(abs(x) for x in xs))


@SETTINGS
@given(x=st.floats(-50, 50, allow_nan=False), a=st.floats(-50, 50, allow_nan=False),
       b=st.floats(-50, 50, allow_nan=False))
def test_rescale_stays_in_range(spark, x, a, b):
    lo, hi = min(a, b), max(a, b)
    df = spark.createDataFrame([(x, lo, hi)], "x double, lo double, hi double")
    r = df.select(rescale("x", "lo", "hi", 0.3, 1.0)).first()[0]
    assert 0.3 - 1e-12 <= r <= 1.0 + 1e-12
    assert r == float(np.interp(x, (lo, hi), (0.3, 1.0))) or abs(r - float(np.interp(x, (lo, hi), (0.3, 1.0)))) < 1e-9


@SETTINGS
@given(series=st.lists(values, min_size=1, max_size=4), width=st.integers(1, 9))
def test_chunking_never_changes_results(spark, series, width):
    """The two-level scan (any chunk width) equals the one-window answer."""
    from pyspark.sql import functions as F
    from gridpulse.operators.scan import series_positions
    recs = [(s, i, v) for s, xs in enumerate(series) for i, v in enumerate(xs)]
    df = spark.createDataFrame(recs, "s int, t int, v double")
    chunk = F.floor(F.col("t") / width)
    plain = {(r.s, r.t): r.v for r in fill_gaps(df, ["s"], ["t"], ["v"]).collect()}
    chunked = {(r.s, r.t): r.v for r in fill_gaps(df, ["s"], ["t"], ["v"], chunk=chunk).collect()}
    assert plain.keys() == chunked.keys()
    for k, a in plain.items():
        b = chunked[k]
        assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(a))
    pos = series_positions(df, ["s"], ["t"], chunk=chunk).collect()
    assert all(r["_pos"] == r["t"] and r["_len"] == len(series[r["s"]]) for r in pos)


TIMES = ["2024-01-03 00:00:00", "2024-01-27 23:59:59", "2024-02-30 10:00:00", "2024-02-29 24:00:00", "2023-02-29 01:00:00", "2024-1-3 00:00:00",
         "2024-01-05T00:00:00", " 2024-01-05 00:00:00", "2024-01-05 00:00:00 ", "2024-01-05 00:00:00\n", "2024-01-05 00:00:00.5", "0000-01-05 00:00:00",
         "2024-01-05 00:60:00", "not-a-time", "", None, "2024-01-28 00:00:00", "2024-01-05 00:00:00Z", "9999-12-31 23:59:59", "٢٠٢٤-01-05 00:00:00"]


def test_both_ways_to_parse_and_range_agree(spark):
    """The fixed pattern, whose range also runs on the text, and the general way."""
    from gridpulse.operators.clean import parse_time_window

    df = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "i int, t string")
    fixed = parse_time_window(df, "t", "2024-01-03 00:00:00", "2024-01-27 23:59:59")
    general = parse_time_window(df, "t", "2024-01-03 00:00:00", "2024-01-27 23:59:59", pattern="yyyy-MM-dd' 'HH:mm:ss")
    assert sorted(map(tuple, fixed.collect())) == sorted(map(tuple, general.collect())) and fixed.count() == 2


def test_cells_of_any_key(spark):
    """Texts with one long prefix, keys of several columns, few and many equal keys:
    many cells, in the order of the keys, with about equal counts."""
    from gridpulse.operators.scan import with_chunks

    base = spark.range(6000).selectExpr("id", "concat('Customer#00000000', lpad(cast(id * 7919 % 6000 as string), 6, '0')) name",
                                        "if(id % 3 = 0, null, id % 50) few", "cast(id % 7 as double) x")
    for order in (["name"], ["few", "name"], ["x", "few", "id"], ["id"]):
        got = with_chunks(base, order, "c", sample=512, cell_rows=100).orderBy(*order).collect()
        chunks = [r.c for r in got]
        assert chunks == sorted(chunks)
        sizes = [chunks.count(c) for c in set(chunks)]
        assert 40 <= len(sizes) <= 60 and max(sizes) < 600, (order, len(sizes), max(sizes))
    one = with_chunks(base.withColumn("k", F.lit("same")), ["k"], "c").select("c").distinct().collect()
    assert len(one) == 1
    assert with_chunks(base.limit(0), ["name"], "c").count() == 0
    assert with_chunks(base.limit(1), ["name"], "c").collect()[0].c == 0
