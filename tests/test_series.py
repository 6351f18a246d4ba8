import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.functions.scalars import floor_ntz
from gridpulse.operators.series import smooth
from gridpulse.plans.dashboard import hourly_series


def _dct_matrix(n):
    k = np.arange(n)[:, None]
    i = np.arange(n)[None, :]
    m = np.cos(np.pi * (2 * i + 1) * k / (2 * n))
    m[0] *= np.sqrt(1.0 / n)
    m[1:] *= np.sqrt(2.0 / n)
    return m


def _np_smooth(x, ratio):
    m = _dct_matrix(len(x))
    c = m @ x
    c[int(len(x) * ratio):] = 0.0
    return m.T @ c


def _frame(spark, series):
    base = dt.datetime(2022, 1, 1)
    recs = [(name, base + dt.timedelta(hours=i), None if v is None else float(v))
            for name, xs in series.items() for i, v in enumerate(xs)]
    return spark.createDataFrame(recs, "s string, ts timestamp_ntz, v double")


@pytest.mark.parametrize("chunked", [False, True])
def test_matches_numpy_dct(spark, chunked):
    rng = np.random.default_rng(11)
    series = {"a": rng.normal(size=160).cumsum(), "b": rng.uniform(0, 5, 75), "c": rng.normal(size=30)}
    df = _frame(spark, series)
    chunk = floor_ntz("ts", "day") if chunked else None
    out = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05, chunk=chunk).toPandas()
    for name, xs in series.items():
        got = out[out.s == name].sort_values("ts")["smoothed"].to_numpy()
        exp = _np_smooth(np.asarray(xs, dtype=float), 0.05)
        assert int(len(xs) * 0.05) >= 1
        assert np.allclose(got, exp, atol=1e-9)


def test_keep_all_is_identity_and_keep_none_is_zero(spark):
    xs = [3.0, None, 5.0, 1.0, 8.0, 2.0, 2.0]
    df = _frame(spark, {"a": xs})
    ident = smooth(df, ["s"], ["ts"], "v", keep_ratio=1.0).orderBy("ts").toPandas()
    assert np.allclose(ident["smoothed"], [0.0 if v is None else v for v in xs], atol=1e-9)
    assert list(ident["raw"]) == [0.0 if v is None else v for v in xs]
    zero = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.02).toPandas()
    assert (zero["smoothed"] == 0.0).all()


def test_sum_preserved(spark):
    rng = np.random.default_rng(2)
    xs = rng.uniform(0, 10, 120)
    out = smooth(_frame(spark, {"a": xs}), ["s"], ["ts"], "v", keep_ratio=0.1).toPandas()
    assert abs(out["smoothed"].sum() - xs.sum()) < 1e-8


def test_hourly_series_selected_flag(spark):
    df = _frame(spark, {"a": list(range(60))})
    out = hourly_series(df, ["s"], "ts", "v", selected=dt.datetime(2022, 1, 2, 0, 0))
    got = out.filter("is_selected").collect()
    assert len(got) == 1 and got[0]["iso"] == "2022-01-02T00:00:00"
    assert out.filter(F.col("is_selected").isNull()).count() == 0


def test_materialized_positions_same_result(spark):
    rng = np.random.default_rng(4)
    df = _frame(spark, {"a": rng.normal(size=100), "b": rng.normal(size=60)})
    a = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05).orderBy("s", "ts").toPandas()
    b = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05, materialize=True).orderBy("s", "ts").toPandas()
    assert np.allclose(a["smoothed"], b["smoothed"], atol=1e-12)


def test_key_named_like_an_internal_column(spark):
    rng = np.random.default_rng(9)
    df = _frame(spark, {"a": rng.normal(size=120), "b": rng.normal(size=80)})
    want = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05).orderBy("s", "ts").toPandas()
    for name in ("k", "c", "part", "raw_"):
        got = smooth(df.withColumnRenamed("s", name), [name], ["ts"], "v", keep_ratio=0.05).orderBy(name, "ts").toPandas()
        assert np.allclose(want["smoothed"], got["smoothed"], atol=1e-12)


def test_chunks_do_not_change_the_result(spark):
    from gridpulse.functions.scalars import floor_ntz

    rng = np.random.default_rng(10)
    df = _frame(spark, {"a": rng.normal(size=150), None: rng.normal(size=90)})
    a = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05).orderBy("s", "ts").toPandas()
    b = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05, chunk=floor_ntz("ts", "day")).orderBy("s", "ts").toPandas()
    assert len(a) == 240 and np.allclose(a["smoothed"], b["smoothed"], atol=1e-12)


LONG = {"prime": 997, "even": 600, "power": 1024, None: 40, "least": 65}


@pytest.mark.parametrize("ratio", [0.0005, 0.02, 0.3, 1.0])
def test_series_longer_than_a_cell(spark, ratio):
    """Cells of 64 points: all but one series go through the four-step transforms,
    of prime lengths too."""
    rng = np.random.default_rng(1)
    series = {k: rng.normal(size=n).cumsum() for k, n in LONG.items()}
    df = _frame(spark, series).withColumn("place", F.struct(F.lit(1).alias("x"), F.array(F.lit("y")).alias("z")))
    out = smooth(df, ["s"], ["ts"], "v", keep_ratio=ratio, points=64)
    assert out.columns == df.columns + ["raw", "n_points", "pos", "smoothed"]
    got = out.toPandas()
    assert len(got) == sum(LONG.values())
    for name, xs in series.items():
        mine = got[got.s.isna() if name is None else got.s == name].sort_values("ts")
        assert np.allclose(mine["smoothed"], _np_smooth(xs, ratio), atol=1e-9)
        assert list(mine["pos"]) == list(range(len(xs))) and np.array_equal(mine["raw"], xs)


@pytest.mark.parametrize("points", [1, 2, 7, 64, 1 << 16])
def test_grids_of_cells(spark, points):
    """The cells of a grid and their number as a column; no cell and no group of
    columns outgrows the bound, as long as M is at most its square."""
    from gridpulse.operators.series import _cells_of, _Grid

    lengths = [3, 64, 65, 1000, 70_000, 1 << 20, (1 << 30) + 7]
    told = spark.createDataFrame([(n, int(n * 0.02)) for n in lengths], "n long, k int").select("n", _cells_of(F.col("n"), F.col("k"), points).alias("m2"))
    told = {r.n: r.m2 for r in told.collect()}
    for n in lengths:
        grid = _Grid(n, int(n * 0.02), points)
        assert grid.m2 == told[n] and grid.m1 * grid.m2 == grid.m >= n + int(n * 0.02)
        if grid.m <= points * points // 4:
            assert grid.m1 <= points and grid.width * grid.m2 <= points


def test_a_long_series_is_in_many_tasks(spark):
    """A third of the rows in one series: no group of the plan holds more than a cell."""
    xs = np.sin(np.arange(6000) / 50)
    df = _frame(spark, {"hot": xs, **{f"s{i}": xs[:60] for i in range(100)}})
    out = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.02, points=256).where("s = 'hot'").orderBy("ts").toPandas()
    assert np.allclose(out["smoothed"], _np_smooth(xs, 0.02), atol=1e-9)


def test_bounded_series_are_ordered_in_their_cell(spark):
    rng = np.random.default_rng(12)
    df = _frame(spark, {"a": rng.normal(size=130), None: rng.normal(size=90), "z": [None, 2.0, 5.0]}).orderBy(F.rand(3))
    a = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05)
    b = smooth(df, ["s"], ["ts"], "v", keep_ratio=0.05, max_points=130)
    assert a.columns[:-3] == b.columns[:-3] and set(a.columns) == set(b.columns)
    a, b = (x.select(sorted(x.columns)).orderBy("s", "ts").toPandas() for x in (a, b))
    assert np.allclose(a["smoothed"], b["smoothed"], atol=1e-12) and (a["pos"] == b["pos"]).all() and (a["n_points"] == b["n_points"]).all()


def test_a_broken_bound_is_an_error(spark):
    with pytest.raises(Exception, match="more than max_points = 59"):
        smooth(_frame(spark, {"a": range(60)}), ["s"], ["ts"], "v", max_points=59).collect()
