"""Back-tests and the ABCD pattern against brute force and hand-worked series."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tickframe.operators import strategy


def abcd_brute(trend, skip=4, ma=7):
    """The O(N⁴) quadruple search, spelled out as the definition."""
    m = pd.Series(trend).rolling(ma).mean().to_numpy()
    n = len(m)
    ac, bd = set(), set()
    for a in range(n):
        for b in range(a, n, skip):
            for c in range(b, n, skip):
                for d in range(c, n, skip):
                    if m[b] > m[a] and m[a] < m[c] < m[b] and m[d] > m[b]:
                        ac.update((a, c))
                        bd.update((b, d))
    sig = np.zeros(n)
    sig[list(ac - bd)] = 1.0
    sig[list(bd - ac)] = -1.0
    return sig


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=30), min_size=8, max_size=44))
def test_abcd_matches_brute_force(values):
    trend = np.array(values, dtype=float)
    ma = pd.Series(trend).rolling(7).mean().to_numpy()
    assert np.array_equal(strategy.abcd_signal_array(ma, 4), abcd_brute(trend))


def test_abcd_no_pattern_is_all_zero():
    ma = pd.Series(np.arange(30, dtype=float)).rolling(7).mean().to_numpy()
    assert not strategy.abcd_signal_array(ma).any()


def test_signal_trades_hand_worked():
    price = np.array([10.0, 11.0, 12.0, 9.0, 15.0, 20.0])
    sig = np.array([1, 1, -1, 0, -1, -1])
    rows = strategy.signal_trades(price, sig, initial_money=25.0, max_buy=1, max_sell=1)
    # day0 buy at 10 (cash 15), day1 buy at 11 (cash 4), day2 sell at 12 (cash 16, ret vs day1 = 9.09 %),
    # day4 sell at 15 (cash 31), day5 sell recorded with empty inventory
    acts = [(r[0], r[1], r[2], r[5], r[6]) for r in rows]
    assert acts == [(0, "buy", True, 15.0, 1.0), (1, "buy", True, 4.0, 2.0), (2, "sell", True, 16.0, 1.0),
                    (4, "sell", True, 31.0, 0.0), (5, "sell", False, 31.0, 0.0)]
    assert abs(rows[2][7] - (12 - 11) / 11 * 100) < 1e-12


def test_signal_trades_buy_without_cash_is_recorded():
    rows = strategy.signal_trades(np.array([50.0, 40.0]), np.array([1, -1]), initial_money=30.0)
    assert rows[0][:3] == (0, "buy", False) and rows[1][:3] == (1, "sell", False)


def test_holdout_days_not_traded():
    rows = strategy.signal_trades(np.ones(40), np.ones(40), initial_money=100.0, n_trade=40 - int(0.025 * 40))
    assert max(r[0] for r in rows) == 38


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=1, max_value=100), min_size=2, max_size=60),
       st.lists(st.sampled_from([-1, 0, 1]), min_size=60, max_size=60))
def test_cash_conservation(prices, sig):
    p = np.array(prices)
    rows = strategy.signal_trades(p, np.array(sig[:len(p)]), initial_money=200.0)
    spent = sum(r[3] * r[4] for r in rows if r[1] == "buy")
    got = sum(r[3] * r[4] for r in rows if r[1] == "sell")
    final = rows[-1][5] if rows else 200.0
    assert abs(final - (200.0 - spent + got)) < 1e-6
    inv = sum(r[3] for r in rows if r[1] == "buy") - sum(r[3] for r in rows if r[1] == "sell")
    assert (rows[-1][6] if rows else 0.0) == inv


def test_rolling_trades_hand_worked():
    price = np.array([10.0, 11.0, 12.0, 13.0, 12.0, 11.0, 10.0])
    rows = strategy.rolling_trades(price, delay=1, initial_state=1, initial_money=100.0)
    # buy day 0; rises on days 1, 2 → the second rise (day 2) switches to sell; falls on 4, 5 → buy on day 5
    assert [(r[0], r[1], r[2]) for r in rows] == [(0, "buy", True), (2, "sell", True), (5, "buy", True)]


def test_backtest_spark_matches_kernel(spark):
    from pyspark.sql import functions as F
    import datetime as dt
    price = [10.0, 11.0, 12.0, 9.0, 15.0, 20.0]
    sig = [1.0, 1.0, -1.0, 0.0, -1.0, -1.0]
    df = spark.createDataFrame([("A", dt.date(2021, 1, i + 1), p, s) for i, (p, s) in enumerate(zip(price, sig))],
                               "Name string, Date date, Close double, signal double")
    t = strategy.backtest(df, "Name", "Date", "Close", "signal", 25.0).orderBy("day").collect()
    assert [r["cash"] for r in t] == [15.0, 4.0, 16.0, 31.0, 31.0]
    s = strategy.summarize(strategy.backtest(df, "Name", "Date", "Close", "signal", 25.0),
                           df.select("Name").distinct(), "Name", 25.0).first()
    assert (s["n_buy_days"], s["n_sell_days"], s["total_gains"]) == (2, 3, 6.0)
