"""Series operators against pandas on the same rows, and skew-safe lag against plain lag."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import strategy, timeseries as ts, windows
from tickframe.plans.prices import prices

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def px(spark):
    return prices(spark, SF_SMALL).select("Name", "Date", "Close").cache()


@pytest.fixture(scope="module")
def pdf(px):
    return px.toPandas().sort_values(["Name", "Date"]).reset_index(drop=True)


def _by_key(df, col):
    return {(r["Name"], str(r["Date"])): r[col] for r in df.collect()}


def _close(a, b, tol=1e-9):
    if a is None or (isinstance(a, float) and np.isnan(a)):
        return b is None or (isinstance(b, float) and np.isnan(b))
    return b is not None and not np.isnan(b) and abs(a - b) <= tol * max(1.0, abs(b))


@pytest.mark.parametrize("fn,window,minp,shift", [("mean", 5, 1, 0), ("mean", 30, None, 0), ("std", 10, None, 0),
                                                  ("max", 7, None, 1), ("min", 7, None, 1)])
def test_rolling_matches_pandas(px, pdf, fn, window, minp, shift):
    got = _by_key(windows.rolling(px, "Name", "Date", "Close", fn, window, minp, shift, out="r"), "r")
    for name, g in pdf.groupby("Name"):
        s = g["Close"].shift(shift) if shift else g["Close"]
        exp = getattr(s.rolling(window, min_periods=minp), fn)()
        for d, e in zip(g["Date"], exp):
            assert _close(got[(name, str(d))], None if np.isnan(e) else float(e), 1e-9), (name, d)


def test_pct_change_pads_gaps(spark):
    df = spark.createDataFrame([("A", 1, 10.0), ("A", 2, None), ("A", 3, 12.0), ("A", 4, 6.0)], "Name string, t int, v double")
    got = [r["pct_change"] for r in windows.pct_change(df, "Name", "t", "v").orderBy("t").collect()]
    exp = pd.Series([10.0, None, 12.0, 6.0]).ffill().pct_change().tolist()
    assert got[0] is None and all(_close(g, e) for g, e in zip(got[1:], exp[1:]))


def test_densify_row_count_equals_day_span(px, pdf):
    dense = ts.densify(px, "Name", "Date", ["Close"])
    got = {r["Name"]: r["n"] for r in dense.groupBy("Name").agg(F.count("*").alias("n")).collect()}
    for name, g in pdf.groupby("Name"):
        assert got[name] == (pd.to_datetime(g["Date"]).max() - pd.to_datetime(g["Date"]).min()).days + 1
    assert dense.filter(F.col("Close").isNull()).count() == 0


@pytest.mark.parametrize("w", [0.3, 0.4, 0.7])
def test_ewma_matches_pandas(px, pdf, w):
    got = _by_key(strategy.ewma(px, "Name", "Date", "Close", w), "ewma")
    for name, g in pdf.groupby("Name"):
        exp = g["Close"].ewm(alpha=1 - w, adjust=False).mean()
        for d, e in zip(g["Date"], exp):
            assert _close(got[(name, str(d))], float(e), 1e-9)


def test_breakout_matches_pandas(px, pdf):
    got = {(r["Name"], str(r["Date"])): r for r in ts.breakout_signal(px, "Name", "Date", "Close").collect()}
    for name, g in pdf.groupby("Name"):
        n = int(np.ceil(len(g) * 0.1))
        rmax = g["Close"].shift(1).rolling(n).max()
        rmin = g["Close"].shift(1).rolling(n).min()
        sig = np.zeros(len(g))
        sig[(rmax < g["Close"]).to_numpy()] = -1
        sig[(rmin > g["Close"]).to_numpy()] = 1
        for d, a, b, s in zip(g["Date"], rmax, rmin, sig):
            r = got[(name, str(d))]
            assert _close(r["prior_max"], None if np.isnan(a) else a) and _close(r["prior_min"], None if np.isnan(b) else b)
            assert r["signal"] == s


def test_ma_signal_matches_pandas(px, pdf):
    got = {(r["Name"], str(r["Date"])): r for r in ts.ma_signal(px, "Name", "Date", "Close").collect()}
    for name, g in pdf.groupby("Name"):
        sw, lw = max(1, int(0.025 * len(g))), max(1, int(0.05 * len(g)))
        short = g["Close"].rolling(sw, min_periods=1).mean().to_numpy()
        long = g["Close"].rolling(lw, min_periods=1).mean().to_numpy()
        sig = np.zeros(len(g))
        sig[sw:] = np.where(short[sw:] > long[sw:], 1.0, 0.0)
        for i, d in enumerate(g["Date"]):
            r = got[(name, str(d))]
            assert _close(r["short_ma"], short[i]) and _close(r["long_ma"], long[i]) and r["signal"] == sig[i]


def test_lag_split_equals_plain_lag_with_hot_key(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # make one user own a third of all rows
    hot = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    a = windows.lag_split(hot, ["user_id"], ["ts", "event_id"], ["event_id"], F.date_trunc("hour", "ts"))
    b = hot.withColumn("prev_event_id", F.lag("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    ga = {r["event_id"]: r["prev_event_id"] for r in a.select("event_id", "prev_event_id").collect()}
    gb = {r["event_id"]: r["prev_event_id"] for r in b.select("event_id", "prev_event_id").collect()}
    assert ga == gb and len(ga) == e.count()


def test_discounted_sum_backwards(spark):
    df = spark.createDataFrame([("A", i, float(v)) for i, v in enumerate([1, 2, 3])], "Name string, t int, r double")
    out = [r["discounted"] for r in strategy.discounted_sum(
        df.withColumn("t", F.make_date(F.lit(2020), F.lit(1), F.col("t") + 1)), "Name", "t", "r", 0.9)
        .orderBy("t").collect()]
    assert _close(out[2], 3.0) and _close(out[1], 2 + 0.9 * 3) and _close(out[0], 1 + 0.9 * (2 + 0.9 * 3))
