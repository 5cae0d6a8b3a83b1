"""Groups with a NULL key, overlapping bands, tied ranks, key and date types, impossible prices."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import quantiles, relational as rel, stats, strategy, timeseries as ts, windows


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, n, float(10 * n + (k or 0))) for k in (1, None) for n in range(1, 9)]
    return spark.createDataFrame(data, "k int, n int, x double").cache()


def by_key(df, *cols):
    out = {}
    for r in df.orderBy("n").collect() if "n" in df.columns else df.collect():
        out.setdefault(r["k"], []).append(tuple(r[c] for c in cols))
    return out


def test_null_safe_join(spark, rows):
    other = spark.createDataFrame([(None, "null"), (1, "one")], "k int, name string")
    got = rel.null_safe_join(rows, other, "k")
    assert got.columns == ["k", "n", "x", "name"] and got.count() == 16
    assert rel.null_safe_join(rows, other, ["k"], "left_anti").count() == 0


def test_distinct_counts(rows):
    got = rel.distinct_counts(rows, ["k"], {"d": "x"}, [F.count(F.lit(1)).alias("c")])
    assert by_key(got, "c", "d") == {1: [(8, 8)], None: [(8, 8)]}


def test_histogram_and_quantiles(rows):
    h = stats.histogram(rows, "x", 2, ["k"]).groupBy("k").agg(F.sum("count").alias("c"))
    assert by_key(h, "c") == {1: [(8,)], None: [(8,)]}
    q = quantiles.exact_percentiles(rows, ["k"], "x", [0.5])
    assert by_key(q, "x") == {1: [(46.0,)], None: [(45.0,)]}
    assert stats.describe(rows, ["x"], ["k"]).filter("q50 IS NULL").count() == 0


def test_minmax_and_its_inverse(rows):
    scaled = ts.minmax(rows, "k", "x")
    assert scaled.count() == 16 and scaled.agg(F.max("scaled")).first()[0] == 1.0
    ranges = rows.groupBy("k").agg(F.min("x").alias("min"), F.max("x").alias("max"))
    back = ts.minmax_inverse(scaled, ranges, "k", "scaled", "y")
    assert back.filter("abs(x - y) > 1e-9").count() == 0 and back.count() == 16


def test_lag_split_and_signals(rows):
    got = by_key(windows.lag_split(rows, ["k"], ["n"], ["n"], F.floor(F.col("n") / 3)), "prev_n")
    assert got[1] == got[None] == [(None,)] + [(n,) for n in range(1, 8)]
    ma = by_key(ts.ma_signal(rows, "k", "n", "x", 0.25, 0.5), "short_ma", "long_ma")
    assert ma[None] == [(a - 1, b - 1) for a, b in ma[1]]
    br = by_key(ts.breakout_signal(rows, "k", "n", "x", 0.25), "signal")
    assert br[1] == br[None] and set(br[1]) == {(0.0,), (-1.0,)}


def test_densify(spark):
    day = dt.date(2021, 1, 1)
    df = spark.createDataFrame([(None, day, 1.0), (None, day + dt.timedelta(3), 4.0)], "k string, d date, x double")
    assert [r.x for r in ts.densify(df, "k", "d", ["x"]).orderBy("d").collect()] == [1.0, 1.0, 1.0, 4.0]


def test_overlapping_bands(rows):
    bands = {"a": F.col("n") <= 4, "b": F.col("n").between(3, 6), "c": F.col("n") > 90}
    one = rel.band_scalars(rows, bands, {"n": lambda: F.count("x")}).first().asDict()
    assert one == {"a_n": 8, "b_n": 8, "c_n": 0}


def test_tied_ranks(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9)], "item string, score int")
    got = {(r.rnk, r.best_item, r.worst_item) for r in rel.pair_extremes(df, "item", "score", 3).collect()}
    assert got == {(1, "a", "c"), (1, "b", "c")}


def test_impossible_prices_are_no_trade():
    assert strategy.signal_trades(np.array([0.0, 2.0, 0.0]), np.array([1, 1, -1]), 10.0)[0][2] is False
    log = strategy.rolling_trades(np.array([0.0, np.nan, 3.0, 2.0, 5.0, 0.0]), delay=0, initial_money=10.0)
    assert all(np.isfinite(r[5]) for r in log) and log[0][2] is False


@pytest.mark.parametrize("delay", [0, 1, 3])
def test_rolling_trades_switch_after_opposing_moves(delay):
    """The rule day by day: count moves against the state, switch on the one after ``delay``."""
    rng = np.random.default_rng(delay)
    price = rng.integers(1, 6, 200).astype(float)
    state, count, days = 1, 0, [(0, "buy")]
    for i in range(1, len(price)):
        against = price[i] > price[i - 1] if state else price[i] < price[i - 1]
        count += against
        if against and count > delay:
            state, count = 1 - state, 0
            days.append((i, "buy" if state else "sell"))
    assert [r[:2] for r in strategy.rolling_trades(price, delay)] == days


def test_key_and_date_types_are_the_inputs(spark):
    df = spark.createDataFrame([(7, k, float(5 + k % 3), float((-1) ** k)) for k in range(12)], "k int, n long, p double, s double")
    t = strategy.backtest(df, "k", "n", "p", "s")
    assert dict(t.dtypes)["k"] == "int" and dict(t.dtypes)["Date"] == "bigint" and t.count() == 12
    assert strategy.ewma(df, "k", "n", "p", 0.5).count() == 12
    grid = [{"param_id": i, "delay": i % 3, "initial_money": 100.0} for i in range(40)]
    got = strategy.sweep(df, grid, "k", "n", "p", block=16)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 41))
