import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridpulse.operators.impute import fill_gaps
from gridpulse.operators.scan import running_extrema, series_positions


def _pandas_chain(pdf, keys, order, values):
    out = []
    for _, g in pdf.groupby(keys):
        g = g.sort_values(order).copy()
        for v in values:
            g[v] = g[v].interpolate(method="linear").ffill().bfill()
        out.append(g)
    return pd.concat(out).sort_values(keys + [order]).reset_index(drop=True)


def test_golden_row(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])],
                               "s int, t int, v double")
    for chunk in (None, F.floor(F.col("t") / 2)):
        got = [r[0] for r in fill_gaps(df, ["s"], ["t"], ["v"], chunk=chunk).orderBy("t").select("v").collect()]
        assert got == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_matches_pandas_random(spark):
    rng = np.random.default_rng(7)
    recs = []
    for s in range(4):
        for t in range(60):
            recs.append((s, t, float(rng.normal()) if rng.random() < 0.25 else None,
                         float(rng.integers(0, 9)) if rng.random() < 0.5 else float("nan")))
    recs += [(9, 0, None, None), (9, 1, None, None)]
    pdf = pd.DataFrame(recs, columns=["s", "t", "a", "b"])
    df = spark.createDataFrame(recs, "s int, t int, a double, b double")
    exp = _pandas_chain(pdf, ["s"], "t", ["a", "b"])
    for chunk in (None, F.floor(F.col("t") / 7), F.floor(F.col("t") / 50)):
        got = fill_gaps(df, ["s"], ["t"], ["a", "b"], chunk=chunk).toPandas() \
            .sort_values(["s", "t"]).reset_index(drop=True)
        for v in ("a", "b"):
            assert np.allclose(got[v].to_numpy(dtype=float), exp[v].to_numpy(dtype=float),
                               equal_nan=True, rtol=0, atol=1e-12)


def test_keeps_non_null_and_keys(spark):
    df = spark.createDataFrame([(1, 0, 5.0, "x"), (1, 1, None, None), (1, 2, 7.0, "z")],
                               "s int, t int, v double, tag string")
    got = fill_gaps(df, ["s"], ["t"], ["v"]).orderBy("t").collect()
    assert [r.v for r in got] == [5.0, 6.0, 7.0]
    assert [r.tag for r in got] == ["x", None, "z"]
    assert got[0].s == 1 and fill_gaps(df, ["s"], ["t"], ["v"]).columns == df.columns


def test_positions_and_running_extrema_chunked(spark):
    rng = np.random.default_rng(3)
    recs = [(s, t, float(rng.normal())) for s in range(3) for t in range(45)]
    df = spark.createDataFrame(recs, "s int, t int, v double")
    p = series_positions(df, ["s"], ["t"], chunk=F.floor(F.col("t") / 8)).toPandas()
    assert (p["_pos"] == p["t"]).all() and (p["_len"] == 45).all()
    one = df.filter("s = 0")
    a = running_extrema(one, "t", "v", chunk=F.floor(F.col("t") / 4)).toPandas().sort_values("t")
    vals = a["v"].to_numpy()
    assert np.allclose(a["_run_lo"], np.minimum.accumulate(vals))
    assert np.allclose(a["_run_hi"], np.maximum.accumulate(vals))


def test_chunk_edge_cases(spark):
    """Whole chunks of NULLs at the start, middle and end; two key columns;
    a NULL series key forms its own series."""
    xs = [None, None, None, 2.0, None, None, None, None, None, None, 8.0, None, None, None]
    recs = [("a", 1, t, v) for t, v in enumerate(xs)] + [("a", 2, t, float(t)) for t in range(5)] \
        + [(None, 1, t, v) for t, v in enumerate([1.0, None, 3.0])]
    df = spark.createDataFrame(recs, "k1 string, k2 int, t int, v double")
    for width in (3, 4, 100):
        got = fill_gaps(df, ["k1", "k2"], ["t"], ["v"], chunk=F.floor(F.col("t") / width))
        a1 = [r[0] for r in got.filter("k1 = 'a' AND k2 = 1").orderBy("t").select("v").collect()]
        exp = pd.Series(xs, dtype=float).interpolate(method="linear").ffill().bfill().tolist()
        assert a1 == exp, width
        a2 = [r[0] for r in got.filter("k1 = 'a' AND k2 = 2").orderBy("t").select("v").collect()]
        assert a2 == [0.0, 1.0, 2.0, 3.0, 4.0]
        nk = [r[0] for r in got.filter("k1 IS NULL").orderBy("t").select("v").collect()]
        assert nk == [1.0, 2.0, 3.0]
