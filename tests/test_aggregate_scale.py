import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from gridpulse.operators.aggregate import (cumulative_by_day, day_totals, first_non_null,
                                           share_of_total, sign_split, zero_filled)
from gridpulse.operators.joins import left_join_keep_first, reverse_lookup
from gridpulse.operators.scale import group_rescale, running_rescale, zscore_size
from conftest import rows


def test_first_non_null_skips_leading_null(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 2, 3.5), ("A", 3, 4.0), ("B", 1, None)],
                               "m string, t int, d double")
    got = {r["m"]: r["d"] for r in rows(first_non_null(df, ["m"], "d", "t"))}
    assert got == {"A": 3.5, "B": None}


def test_day_totals_and_zero_fill(spark):
    h = dt.datetime(2022, 1, 2, 5)
    prod = spark.createDataFrame([(h, 101, 1.5), (h, 101, 2.0), (dt.datetime(2022, 1, 3, 0), 101, 9.0),
                                  (h, 999, 4.0)], "hour_utc timestamp_ntz, code int, v double")
    dim = spark.createDataFrame([(101,), (102,)], "lau int")
    t = day_totals(prod, ["code"], "hour_utc", "v", "2022-01-02", out="total")
    got = {r["lau"]: r["total"] for r in rows(zero_filled(dim, "lau", t, "code", ["total"]))}
    assert got == {101: 3.5, 102: 0.0}


def test_sign_split_properties(spark):
    rng = np.random.default_rng(0)
    data = [("DK1" if i % 3 else "DK2", float(rng.normal() * 10)) for i in range(200)]
    df = spark.createDataFrame(data, "area string, v double")
    got = rows(sign_split(df, ["area"], "v", net="net"), "area")
    for r in got:
        assert abs(r["import_mwh"] + r["export_mwh"] - r["net"]) < 1e-9
        assert r["import_mwh"] <= 0 <= r["export_mwh"]
    empty = sign_split(df.filter("v > 1e9"), [], "v")
    assert rows(empty) == [{"import_mwh": 0.0, "export_mwh": 0.0}]


def test_share_sums_to_one_and_zero_total(spark):
    df = spark.createDataFrame([("g", "import", -3.0), ("g", "export", 1.0), ("z", "import", 0.0),
                                ("z", "export", 0.0)], "k string, d string, v double")
    got = rows(share_of_total(df, ["k"], "v"), "k", "d")
    assert abs(sum(r["share"] for r in got if r["k"] == "g") - 1.0) < 1e-12
    assert [r["share"] for r in got if r["k"] == "z"] == [None, None]


def test_cumulative_last_day_is_total(spark):
    df = spark.createDataFrame([("x", dt.date(2022, 1, d), float(d)) for d in range(1, 11)],
                               "k string, day date, v double")
    got = rows(cumulative_by_day(df, ["k"], "day", ["v"]), "day")
    assert got[-1]["cum_v"] == sum(range(1, 11))


def _np_interp_loop(sizes, lo_out, hi_out):
    """The dashboard's loop: rescale each value by the running min/max."""
    seen, out = [], []
    for s in sizes:
        seen.append(s)
        out.append(float(np.interp(s, (min(seen), max(seen)), (lo_out, hi_out))))
    return out


def test_running_rescale_matches_loop(spark):
    rng = np.random.default_rng(5)
    sizes = [float(x) for x in rng.uniform(0, 10, 40)]
    sizes[3] = sizes[2]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "code int, size double")
    for lo, width in ((0.0, None), (0.3, 7)):
        got = running_rescale(df, "code", "size", out_lo=lo, chunk=None if width is None else F.floor(F.col("code") / width),
                              n_colors=9)
        got = rows(got, "code")
        exp = _np_interp_loop(sizes, lo, 1.0)
        assert np.allclose([r["scale"] for r in got], exp, atol=1e-12)
        assert [r["color_index"] for r in got] == [int(e * 8) for e in exp]


def test_group_rescale_and_zscore(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", 2.0), ("c", 2.0)],
                               "g string, v double")
    z = rows(zscore_size(df, ["g"], "v", factor=15.0), "g", "v")
    assert abs(z[0]["z_size"] - abs((1 - 2) / np.std([1, 3], ddof=1)) * 15) < 1e-12
    assert z[2]["z_size"] is None  # one row: sample std undefined
    assert z[3]["z_size"] is None  # zero std
    g = rows(group_rescale(df, [], "v", out_lo=0.3, n_colors=9), "v")
    assert g[0]["scale"] == 0.3 and g[-1]["scale"] == 1.0 and g[-1]["color_index"] == 8


def test_join_helpers(spark):
    dim = spark.createDataFrame([("A", 1.0), ("B", None)], "municipality string, distance double")
    right = spark.createDataFrame([("A", 9.0), ("B", 2.0)], "municipality string, distance double")
    got = {r["municipality"]: r["distance"] for r in rows(left_join_keep_first(dim, right, "municipality"))}
    assert got == {"A": 1.0, "B": None}
    got = {r["municipality"]: r["distance"]
           for r in rows(left_join_keep_first(dim, right, "municipality", fill_from_right=True))}
    assert got == {"A": 1.0, "B": 2.0}
    names = spark.createDataFrame([("Aarhus",), ("Nowhere",)], "name string")
    d = spark.createDataFrame([(751, "Aarhus")], "code int, name string")
    got = {r["name"]: r["code"] for r in rows(reverse_lookup(names, "name", d, "name", "code"))}
    assert got == {"Aarhus": 751, "Nowhere": None}


def test_null_group_keys_and_same_key_names(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    z = rows(zscore_size(df, ["g"], "v"), "v")
    assert z[0]["mean"] == 2.0 and z[0]["z_size"] is not None
    g = rows(group_rescale(df, ["g"], "v"), "v")
    assert [r["scale"] for r in g] == [0.0, 1.0, 1.0]
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    agg = spark.createDataFrame([(1, 5.0)], "k int, total double")
    assert rows(zero_filled(dim, "k", agg, "k", ["total"]), "k") == [{"k": 1, "total": 5.0},
                                                                      {"k": 2, "total": 0.0}]
