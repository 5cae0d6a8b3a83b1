"""Series operators: back-tests, ABCD pattern, parameter sweeps, EWMA and discounted sums.

Back-tests and the ABCD pattern are sequential over one series, so they run as
``groupBy(key).applyInPandas``: every key in parallel, one series per task.
A series here is one row per key and trading day (bars), so a group is
bounded by the calendar (about 250 rows per year), not by the raw data
volume.  ABCD membership is vectorised; the back-tests visit only the days
with an order.  Exponential smoothing and discounted sums are affine
recurrences and stay in built-in expressions, for series of any length.
Keys and dates may be of any type; the results carry the input's types.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.operators import pieces

TRADE_COLS = "action string, executed boolean, units double, price double, cash double, inventory double, invest_pct double"


def _type(df: DataFrame, col: str) -> str:
    return f"`{col}` {df.schema[col].dataType.simpleString()}"


# ------------------------------------------------------------------ numpy kernels

class Account:
    """Cash and units of one back-test, and the log of its orders.

    An order is recorded whether it could be carried out or not; a price that
    is not a positive number carries out none."""

    def __init__(self, price: np.ndarray, money: float, max_buy: float, max_sell: float):
        self.price, self.cash, self.units = price, float(money), 0.0
        self.limits = {"buy": max_buy, "sell": max_sell}
        self.bought_at: float | None = None
        self.log: list[tuple] = []

    def order(self, day: int, action: str) -> None:
        p = float(self.price[day])
        most = 0.0
        if p > 0 and np.isfinite(p):
            most = self.cash // p if action == "buy" else self.units
        done = most >= 1 if action == "buy" else most > 0
        n = float(min(most, self.limits[action])) if done else 0.0
        gain = None
        if action == "buy":
            self.cash, self.units, self.bought_at = self.cash - n * p, self.units + n, p
        elif done:
            self.cash, self.units = self.cash + n * p, self.units - n
            if self.bought_at is None:
                gain = 0.0
            elif self.bought_at > 0:
                gain = (p - self.bought_at) / self.bought_at * 100
        self.log.append((int(day), action, bool(done), n, p, self.cash, self.units, gain))


def signal_trades(price: np.ndarray, signal: np.ndarray, initial_money: float = 10000.0, max_buy: float = 1,
                  max_sell: float = 1, n_trade: int | None = None) -> list[tuple]:
    """Back-test on a +1 / −1 / 0 signal: one order on each signalled day.

    Buy: ``min(max_buy, cash // price)`` units when at least one is
    affordable.  Sell: ``min(max_sell, inventory)``.  A sale's return is
    measured against the price of the last recorded buy day.  Only the first
    ``n_trade`` days are traded."""
    signal = np.asarray(signal)[:n_trade if n_trade is None else max(0, n_trade)]
    account = Account(price, initial_money, max_buy, max_sell)
    for day in np.flatnonzero((signal == 1) | (signal == -1)):
        account.order(day, "buy" if signal[day] == 1 else "sell")
    return account.log


def rolling_trades(price: np.ndarray, delay: int = 5, initial_state: int = 1, initial_money: float = 10000.0,
                   max_buy: float = 1, max_sell: float = 1) -> list[tuple]:
    """Back-test without a signal: two states, buying and selling, and a switch
    of state is an order.

    Moves against the state (rises while buying, falls while selling) count
    from the last switch on; the one after the first ``delay`` of them
    switches.  Starting in the buying state is an order on day 0.  Days
    between switches need no look: the next one is found in the sorted list
    of rises or falls."""
    price = np.asarray(price, float)
    account = Account(price, initial_money, max_buy, max_sell)
    step = np.diff(price)
    against = {1: np.flatnonzero(step > 0) + 1, 0: np.flatnonzero(step < 0) + 1}
    state, day = initial_state, 0
    if len(price) and state == 1:
        account.order(0, "buy")
    while True:
        moves = against[state]
        k = np.searchsorted(moves, day, side="right") + delay
        if k >= len(moves):
            return account.log
        day, state = int(moves[k]), 1 - state
        account.order(day, "buy" if state == 1 else "sell")


def _prefix_min(a: np.ndarray) -> np.ndarray:
    """min of a[0..i-1] for each i (+inf for i = 0), NaN ignored."""
    x = np.where(np.isnan(a), np.inf, a)
    out = np.full(len(a), np.inf)
    if len(a) > 1:
        out[1:] = np.minimum.accumulate(x)[:-1]
    return out


def _suffix_max(a: np.ndarray) -> np.ndarray:
    """max of a[i+1..] for each i (−inf for the last), NaN ignored."""
    x = np.where(np.isnan(a), -np.inf, a)
    out = np.full(len(a), -np.inf)
    if len(a) > 1:
        out[:-1] = np.maximum.accumulate(x[::-1])[::-1][1:]
    return out


def abcd_roles(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For one residue class: which positions can be an a or c, and which
    a b or d, of some i<j<k<l with m[j] > m[i], m[i] < m[k] < m[j],
    m[l] > m[j].  O(L²) boolean matrices instead of the O(L⁴) search;
    NaN compares false, so NaN positions take no role."""
    L = len(m)
    if L < 4:
        return np.zeros(L, bool), np.zeros(L, bool)
    pmin, smax = _prefix_min(m), _suffix_max(m)
    mj, mk = m[:, None], m[None, :]
    later = np.triu(np.ones((L, L), bool), 1)  # k > j
    with np.errstate(invalid="ignore"):
        bc = later & (mk < mj) & (smax[None, :] > mj)           # (b=j, c=k) with some d after c
        full = bc & (pmin[:, None] < mk)                          # … and some a before b
        is_b = full.any(axis=1)
        is_c = full.any(axis=0)
        # a: some (j, k) in bc with j > i and m[k] > m[i]
        best = np.where(bc, np.broadcast_to(mk, (L, L)), -np.inf).max(axis=1)
        sbest = _suffix_max(np.where(np.isneginf(best), np.nan, best))
        is_a = sbest > m
        # d: some (j, k) with an a before j, k < l and m[l] > m[j]
        ab_c = later & (mk < mj) & (pmin[:, None] < mk)
        first_k = np.where(ab_c.any(axis=1), ab_c.argmax(axis=1), L)
        is_d = ((first_k[:, None] < np.arange(L)[None, :]) & (m[:, None] < m[None, :])).any(axis=0)
    return is_a | is_c, is_b | is_d


def abcd_signal_array(ma: np.ndarray, skip: int = 4) -> np.ndarray:
    """Buy (+1) at positions that are only ever a or c, sell (−1) at those only
    ever b or d, over quadruples a ≤ b ≤ c ≤ d stepping by ``skip``."""
    n = len(ma)
    ac, bd = np.zeros(n, bool), np.zeros(n, bool)
    for r in range(skip):
        idx = np.arange(r, n, skip)
        a_c, b_d = abcd_roles(ma[idx].astype(float))
        ac[idx], bd[idx] = a_c, b_d
    sig = np.zeros(n)
    sig[ac & ~bd] = 1.0
    sig[bd & ~ac] = -1.0
    return sig


# ------------------------------------------------------------------ Spark operators

def _trade_schema(df: DataFrame, key: str, order: str) -> str:
    return f"{_type(df, key)}, day long, Date {df.schema[order].dataType.simpleString()}, {TRADE_COLS}"


def _trades_frame(key_val, dates, rows, key):
    cols = ["day", "action", "executed", "units", "price", "cash", "inventory", "invest_pct"]
    t = pd.DataFrame(rows, columns=cols)
    t.insert(0, key, key_val)
    t.insert(2, "Date", dates[t["day"].to_numpy()] if len(t) else pd.Series([], dtype="object"))
    t["day"] = t["day"].astype("int64")
    return t


def backtest(df: DataFrame, key: str, order: str, price: str, signal: str, initial_money: float = 10000.0,
             max_buy: float = 1, max_sell: float = 1, holdout_frac: float = 0.0) -> DataFrame:
    """ts.backtest_signal: one row per signalled day (buy / sell, executed or
    not) with cash and inventory after it.  The last ``int(holdout_frac·N)``
    days are not traded (agents 1 and 2: 0.025; agent 23: 0)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        n_trade = len(pdf) - int(holdout_frac * len(pdf))
        rows = signal_trades(pdf[price].to_numpy(float), pdf[signal].to_numpy(float), initial_money, max_buy,
                             max_sell, n_trade)
        return _trades_frame(pdf[key].iloc[0], pdf[order].to_numpy(), rows, key)
    return df.select(key, order, price, signal).groupBy(key).applyInPandas(run, _trade_schema(df, key, order))


def backtest_rolling(df: DataFrame, key: str, order: str, price: str, delay: int = 4, initial_state: int = 1,
                     initial_money: float = 10000.0, max_buy: float = 1, max_sell: float = 1) -> DataFrame:
    """ts.backtest_rolling: the signal-free delay strategy per key."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        rows = rolling_trades(pdf[price].to_numpy(float), delay, initial_state, initial_money, max_buy, max_sell)
        return _trades_frame(pdf[key].iloc[0], pdf[order].to_numpy(), rows, key)
    return df.select(key, order, price).groupBy(key).applyInPandas(run, _trade_schema(df, key, order))


def summarize(trades: DataFrame, keys: DataFrame, key: str, initial_money: float = 10000.0,
              by: tuple[str, ...] = ()) -> DataFrame:
    """Back-test result per key: buy / sell days recorded, total gain and
    gain in % (cash only: inventory left at the end is not valued)."""
    g = trades.groupBy(key, *by).agg(
        F.count(F.when(F.col("action") == "buy", 1)).alias("n_buy_days"),
        F.count(F.when(F.col("action") == "sell", 1)).alias("n_sell_days"),
        F.max_by("cash", "day").alias("final_cash"))
    j = keys.join(g, [key, *by], "left")
    gain = F.coalesce(F.col("final_cash"), F.lit(float(initial_money))) - F.lit(float(initial_money))
    return j.select(key, *by, F.coalesce("n_buy_days", F.lit(0)).alias("n_buy_days"),
                    F.coalesce("n_sell_days", F.lit(0)).alias("n_sell_days"),
                    gain.alias("total_gains"), (gain / initial_money * 100).alias("invest"))


def abcd_signal(df: DataFrame, key: str, order: str, ma_col: str, skip: int = 4) -> DataFrame:
    """ts.abcd_signal: +1 / −1 / 0 per row from the ABCD pattern on a moving
    average column (NaN / NULL where the average is not yet defined)."""
    schema = f"{_type(df, key)}, {_type(df, order)}, signal double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        ma = pdf[ma_col].to_numpy(dtype=float, na_value=np.nan)
        return pd.DataFrame({key: pdf[key].to_numpy(), order: pdf[order].to_numpy(),
                             "signal": abcd_signal_array(ma, skip)})
    return df.select(key, order, ma_col).groupBy(key).applyInPandas(run, schema)


def ewma(df: DataFrame, key: str, order: str, value: str, w: float, out: str = "ewma", split: int | None = None) -> DataFrame:
    """ts.ewma: exponential smoothing ``y = y_prev·w + (1 − w)·x``, y0 = x0.

    Built-in expressions only (``pieces.affine``).  As in the recurrence, a NaN
    stays for all later rows; a NULL row has NULL and is passed over.  With
    ``split``, keys of more rows than that are numbered range by range."""
    x = F.col(f"`{value}`").cast("double")
    return pieces.affine(df.select(key, order, value), key, order, w, x * (1 - w), x, out, split).select(key, order, out)


def discounted_sum(df: DataFrame, key: str, order: str, value: str, gamma: float, out: str = "discounted",
                   split: int | None = None) -> DataFrame:
    """ts.discounted_sum: ``R_t = r_t + γ·R_{t+1}``, computed backwards; NULL counts as 0."""
    r = F.coalesce(F.col(f"`{value}`").cast("double"), F.lit(0.0))
    return pieces.affine(df.select(key, order, value), key, order, gamma, r, None, out, split, descending=True).select(key, order, out)


def sweep(df: DataFrame, params: list[dict], key: str, order: str, price: str,
          initial_state: int = 1, max_buy: float = 1, max_sell: float = 1, block: int = 16) -> DataFrame:
    """ts.param_sweep: the delay back-test for every key and every parameter
    set (``param_id``, ``delay``, ``initial_money``).

    A task has one key and one block of the grid: the bars of a key go out
    once per ``block`` sets, so a long grid spreads over tasks.  Result: one
    row per (key, set) with its gain and its rank within the key."""
    grid = [(int(p["param_id"]), int(p["delay"]), float(p["initial_money"])) for p in params]
    blocks = [grid[k:k + block] for k in range(0, len(grid), block)]
    schema = f"{_type(df, key)}, param_id long, delay int, initial_money double, n_trades long, total_gains double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        x = pdf[price].to_numpy(float)
        out = []
        for pid, d, m in blocks[int(pdf["__block"].iloc[0])]:
            rows = rolling_trades(x, d, initial_state, m, max_buy, max_sell)
            final = rows[-1][5] if rows else m
            out.append((pdf[key].iloc[0], pid, d, m, len(rows), final - m))
        return pd.DataFrame(out, columns=[key, "param_id", "delay", "initial_money", "n_trades", "total_gains"])
    spread = df.select(key, order, price).withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))))
    res = spread.groupBy(key, "__block").applyInPandas(run, schema)
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(F.col("total_gains").desc(), "param_id")
    return res.withColumn("rank", F.row_number().over(w))


def cash_by_day(trades: DataFrame, days: DataFrame, key: str, order: str, initial_money: float = 10000.0) -> DataFrame:
    """The cash balance at the end of every day of the series (the source
    agent's per-day money log): the cash after the day's own trade, else
    after the last earlier trade, else the starting money.  A left join of
    the days with the trades and a forward fill over the key's days."""
    from pyspark.sql import Window
    j = days.select(key, order).join(trades.select(key, order, "cash"), [key, order], "left")
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(key, order, F.coalesce(F.last("cash", ignorenulls=True).over(w),
                                           F.lit(float(initial_money))).alias("cash"))
