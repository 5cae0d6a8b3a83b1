"""Grouped-map strategy queries (kind G) and the k-NN novelty score.

Back-tests are sequential per series.  Their oracles replay the same
cash / inventory state machine row by row with recursive CTEs in DuckDB.
The ABCD oracle uses the O(L²) role conditions as SQL self-joins inside each
residue class; ``tests/test_strategy.py`` checks those conditions against the
O(N⁴) quadruple search itself.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.functions.money import dec

from tickframe.operators import knn, strategy, timeseries as ts
from tickframe.plans.prices import INGEST_DATE, SQL_PRICES, prices
from tickframe.plans.series import SQL_NUMBERED
from tickframe.plans.registry import register
from tickframe.sources.tables import table

INITIAL_MONEY = 10000.0

# ------------------------------------------------------------------ oracle SQL (DuckDB)

_PRICES = SQL_PRICES % {"ingest": INGEST_DATE}

# breakout signal per row (as ts.breakout_signal) with row number and series length
SQL_SIG_BREAKOUT = SQL_NUMBERED + """,
k AS (SELECT *, CAST(ceil(N * 0.1::DOUBLE) AS BIGINT) AS win FROM s),
r AS (SELECT k.Name, k.Date, k.Close, k.rn, k.N, k.win, max(p.Close) AS mx, min(p.Close) AS mn, count(p.Close) AS c
      FROM k LEFT JOIN s p ON p.Name = k.Name AND p.rn BETWEEN k.rn - k.win AND k.rn - 1
      GROUP BY k.Name, k.Date, k.Close, k.rn, k.N, k.win),
sig AS (SELECT Name, Date, Close, rn, N,
               CASE WHEN c = win AND mn > Close THEN 1.0 WHEN c = win AND mx < Close THEN -1.0 ELSE 0.0 END AS signal
        FROM r)"""

# moving-average position changes per row (as ts.ma_signal)
SQL_SIG_MA = SQL_NUMBERED + """,
k AS (SELECT *, greatest(1, CAST(floor(N * 0.025::DOUBLE) AS INTEGER)) AS ns,
                greatest(1, CAST(floor(N * 0.05::DOUBLE) AS INTEGER)) AS nl FROM s),
m AS (SELECT k.*, CAST(k.cs - coalesce(a.cs, 0) AS DOUBLE) / least(k.ns, k.rn) AS short_ma,
             CAST(k.cs - coalesce(b.cs, 0) AS DOUBLE) / least(k.nl, k.rn) AS long_ma
      FROM k LEFT JOIN s a ON a.Name = k.Name AND a.rn = k.rn - k.ns
             LEFT JOIN s b ON b.Name = k.Name AND b.rn = k.rn - k.nl),
g AS (SELECT *, CASE WHEN rn - 1 >= ns AND short_ma > long_ma THEN 1.0 ELSE 0.0 END AS lvl FROM m),
sig AS (SELECT Name, Date, Close, rn, N,
               coalesce(lvl - lag(lvl) OVER (PARTITION BY Name ORDER BY Date), 0.0) AS signal FROM g)"""


def _signal_backtest_sql(sig_sql: str, holdout: float) -> str:
    """Replay of the signal back-test (one unit per trade) over ``sig``."""
    return "WITH RECURSIVE " + _PRICES + sig_sql + f""",
t AS (SELECT *, N - CAST(floor({holdout}::DOUBLE * N) AS BIGINT) AS ntrade FROM sig),
bt AS (
  SELECT Name, CAST(0 AS BIGINT) AS rn, {INITIAL_MONEY}::DOUBLE AS cash, 0.0::DOUBLE AS inv,
         CAST(NULL AS DOUBLE) AS last_buy, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS BOOLEAN) AS executed,
         CAST(NULL AS DOUBLE) AS invest_pct
  FROM (SELECT DISTINCT Name FROM t)
  UNION ALL
  SELECT s.Name, s.rn,
         CASE WHEN s.signal = 1 AND bt.cash >= s.Close THEN bt.cash - s.Close
              WHEN s.signal = -1 AND bt.inv > 0 THEN bt.cash + s.Close ELSE bt.cash END,
         CASE WHEN s.signal = 1 AND bt.cash >= s.Close THEN bt.inv + 1
              WHEN s.signal = -1 AND bt.inv > 0 THEN bt.inv - 1 ELSE bt.inv END,
         CASE WHEN s.signal = 1 THEN s.Close ELSE bt.last_buy END,
         CASE WHEN s.signal = 1 THEN 'buy' WHEN s.signal = -1 THEN 'sell' END,
         CASE WHEN s.signal = 1 THEN bt.cash >= s.Close WHEN s.signal = -1 THEN bt.inv > 0 END,
         CASE WHEN s.signal = -1 AND bt.inv > 0 THEN coalesce((s.Close - bt.last_buy) / bt.last_buy * 100, 0.0) END
  FROM bt JOIN t s ON s.Name = bt.Name AND s.rn = bt.rn + 1
  WHERE s.rn <= s.ntrade),
trades AS (
  SELECT bt.Name, bt.rn - 1 AS day, CAST(t.Date AS VARCHAR) AS Date, action, executed,
         CASE WHEN executed THEN 1.0 ELSE 0.0 END AS units, t.Close AS price, cash, inv AS inventory, invest_pct
  FROM bt JOIN t ON bt.Name = t.Name AND bt.rn = t.rn WHERE action IS NOT NULL)"""


SQL_TRADES_SUMMARY = f"""
SELECT k.Name, coalesce(n_buy_days, 0) AS n_buy_days, coalesce(n_sell_days, 0) AS n_sell_days,
       coalesce(final_cash, {INITIAL_MONEY}) - {INITIAL_MONEY} AS total_gains,
       (coalesce(final_cash, {INITIAL_MONEY}) - {INITIAL_MONEY}) / {INITIAL_MONEY} * 100 AS invest
FROM (SELECT DISTINCT Name FROM prices) k LEFT JOIN (
  SELECT Name, count(*) FILTER (WHERE action = 'buy') AS n_buy_days, count(*) FILTER (WHERE action = 'sell') AS n_sell_days,
         arg_max(cash, day) AS final_cash FROM trades GROUP BY Name) g ON k.Name = g.Name"""


# ABCD roles per residue class (step 4) on the exact 7-row moving average; see strategy.abcd_roles
SQL_SIG_ABCD = """,
s AS (SELECT Name, Date, Close, row_number() OVER (PARTITION BY Name ORDER BY Date) AS rn,
             CASE WHEN count(*) OVER w7 = 7 THEN CAST(sum(CAST(Close AS DECIMAL(18,2))) OVER w7 AS DOUBLE) / 7 END AS m
      FROM prices WINDOW w7 AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
ab AS (SELECT *, (rn - 1) % 4 AS cls, (rn - 1) // 4 AS idx,
             min(m) OVER (PARTITION BY Name, (rn - 1) % 4 ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmin,
             max(m) OVER (PARTITION BY Name, (rn - 1) % 4 ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS smax
      FROM s),
pr AS (SELECT j.Name, j.cls, j.idx AS jx, k.idx AS kx, j.m AS mj, k.m AS mk, j.pmin AS pmin_j, k.smax AS smax_k
       FROM ab j JOIN ab k ON j.Name = k.Name AND j.cls = k.cls AND k.idx > j.idx AND k.m < j.m),
bc AS (SELECT * FROM pr WHERE smax_k > mj),
full_ AS (SELECT * FROM bc WHERE pmin_j < mk),
best AS (SELECT Name, cls, jx, max(mk) AS best FROM bc GROUP BY 1, 2, 3),
firstk AS (SELECT Name, cls, jx, mj, min(kx) AS fk FROM pr WHERE pmin_j < mk GROUP BY 1, 2, 3, 4),
roles AS (
  SELECT ab.Name, ab.Date, ab.rn,
         EXISTS (SELECT 1 FROM best b WHERE b.Name = ab.Name AND b.cls = ab.cls AND b.jx > ab.idx AND b.best > ab.m)
         OR EXISTS (SELECT 1 FROM full_ f WHERE f.Name = ab.Name AND f.cls = ab.cls AND f.kx = ab.idx) AS ac,
         EXISTS (SELECT 1 FROM full_ f WHERE f.Name = ab.Name AND f.cls = ab.cls AND f.jx = ab.idx)
         OR EXISTS (SELECT 1 FROM firstk x WHERE x.Name = ab.Name AND x.cls = ab.cls AND x.fk < ab.idx AND x.mj < ab.m) AS bd
  FROM ab),
abcd AS (SELECT Name, Date, rn, CASE WHEN ac AND NOT bd THEN 1.0 WHEN bd AND NOT ac THEN -1.0 ELSE 0.0 END AS signal
         FROM roles)"""


def _rolling_backtest_sql(params_sql: str) -> str:
    """Replay of the delay strategy for every (symbol, parameter set) in ``params``
    (param_id, delay, initial_money); starts in the buy state."""
    return "WITH RECURSIVE " + _PRICES + f""",
params(param_id, delay, initial_money) AS ({params_sql}),
s AS (SELECT Name, Date, Close, row_number() OVER (PARTITION BY Name ORDER BY Date) AS rn FROM prices),
bt AS (
  SELECT s.Name, p.param_id, p.delay, p.initial_money, s.rn, s.Close AS cur, CAST(1 AS INTEGER) AS state,
         CAST(0 AS INTEGER) AS dec,
         CASE WHEN p.initial_money >= s.Close THEN p.initial_money - s.Close ELSE p.initial_money END AS cash,
         CASE WHEN p.initial_money >= s.Close THEN 1.0 ELSE 0.0 END AS inv, s.Close AS last_buy,
         'buy' AS action, p.initial_money >= s.Close AS executed, CAST(NULL AS DOUBLE) AS invest_pct
  FROM s, params p WHERE s.rn = 1
  UNION ALL
  SELECT n.Name, b.param_id, b.delay, b.initial_money, n.rn, n.Close,
         CASE WHEN n.Close < b.cur AND b.state = 0 AND b.dec >= b.delay THEN 1
              WHEN n.Close > b.cur AND b.state = 1 AND b.dec >= b.delay THEN 0 ELSE b.state END,
         CASE WHEN ((n.Close < b.cur AND b.state = 0) OR (n.Close > b.cur AND b.state = 1)) AND b.dec < b.delay
              THEN b.dec + 1
              WHEN (n.Close < b.cur AND b.state = 0) OR (n.Close > b.cur AND b.state = 1) THEN 0 ELSE b.dec END,
         CASE WHEN n.Close < b.cur AND b.state = 0 AND b.dec >= b.delay AND b.cash >= n.Close THEN b.cash - n.Close
              WHEN n.Close > b.cur AND b.state = 1 AND b.dec >= b.delay AND b.inv > 0 THEN b.cash + n.Close
              ELSE b.cash END,
         CASE WHEN n.Close < b.cur AND b.state = 0 AND b.dec >= b.delay AND b.cash >= n.Close THEN b.inv + 1
              WHEN n.Close > b.cur AND b.state = 1 AND b.dec >= b.delay AND b.inv > 0 THEN b.inv - 1
              ELSE b.inv END,
         CASE WHEN n.Close < b.cur AND b.state = 0 AND b.dec >= b.delay THEN n.Close ELSE b.last_buy END,
         CASE WHEN n.Close < b.cur AND b.state = 0 AND b.dec >= b.delay THEN 'buy'
              WHEN n.Close > b.cur AND b.state = 1 AND b.dec >= b.delay THEN 'sell' END,
         CASE WHEN n.Close < b.cur AND b.state = 0 AND b.dec >= b.delay THEN b.cash >= n.Close
              WHEN n.Close > b.cur AND b.state = 1 AND b.dec >= b.delay THEN b.inv > 0 END,
         CASE WHEN n.Close > b.cur AND b.state = 1 AND b.dec >= b.delay AND b.inv > 0
              THEN (n.Close - b.last_buy) / b.last_buy * 100 END
  FROM bt b JOIN s n ON n.Name = b.Name AND n.rn = b.rn + 1)"""


def _keys(p):
    return p.select("Name").distinct()


def _turtle_trades(p):
    sig = ts.breakout_signal(p, "Name", "Date", "Close", 0.1)
    return strategy.backtest(sig, "Name", "Date", "Close", "signal", INITIAL_MONEY, 1, 1, holdout_frac=0.025)


@register("ts.backtest_signal", _signal_backtest_sql(SQL_SIG_BREAKOUT, 0.025) + " SELECT * FROM trades")
def ts_backtest_signal(spark, d):
    """Breakout (turtle) signal → cash/inventory back-test, last 2.5 % held out."""
    return _turtle_trades(prices(spark, d))


@register("ts.backtest_signal.summary", _signal_backtest_sql(SQL_SIG_BREAKOUT, 0.025) + SQL_TRADES_SUMMARY)
def ts_backtest_signal_summary(spark, d):
    """Buys, sells, total gain and gain in % per symbol."""
    p = prices(spark, d)
    return strategy.summarize(_turtle_trades(p), _keys(p), "Name", INITIAL_MONEY)


@register("ts.backtest_signal.ma", _signal_backtest_sql(SQL_SIG_MA, 0.025) + " SELECT * FROM trades")
def ts_backtest_ma(spark, d):
    """Moving-average crossover signal → back-test on the +1 / −1 position changes."""
    p = prices(spark, d)
    sig = ts.ma_signal(p, "Name", "Date", "Close").withColumn("trade", F.coalesce("positions", F.lit(0.0)))
    return strategy.backtest(sig, "Name", "Date", "Close", "trade", INITIAL_MONEY, 1, 1, holdout_frac=0.025)


def _ma7(p):
    """7-row moving average (full windows only) from an exact DECIMAL sum."""
    w = Window.partitionBy("Name").orderBy("Date").rowsBetween(-6, 0)
    return p.withColumn("ma7", F.when(F.count(F.lit(1)).over(w) == 7,
                                      F.sum(dec("Close")).over(w).cast("double") / 7))


@register("ts.abcd_signal", "WITH " + _PRICES + SQL_SIG_ABCD + """
SELECT Name, CAST(Date AS VARCHAR) AS Date, signal FROM abcd""")
def ts_abcd_signal(spark, d):
    """ABCD pattern on the 7-row moving average."""
    return strategy.abcd_signal(_ma7(prices(spark, d)), "Name", "Date", "ma7", skip=4)


@register("ts.backtest_signal.abcd", _signal_backtest_sql(SQL_SIG_ABCD + """,
sig AS (SELECT a.Name, a.Date, p.Close, a.rn, count(*) OVER (PARTITION BY a.Name) AS N, a.signal
        FROM abcd a JOIN prices p ON a.Name = p.Name AND a.Date = p.Date)""", 0.0) + " SELECT * FROM trades")
def ts_backtest_abcd(spark, d):
    """ABCD signal → back-test over every day (no hold-out)."""
    return _abcd_trades(spark, d)


def _abcd_trades(spark, d):
    p = prices(spark, d)
    sig = strategy.abcd_signal(_ma7(p), "Name", "Date", "ma7", skip=4)
    j = p.select("Name", "Date", "Close").join(sig, ["Name", "Date"])
    return strategy.backtest(j, "Name", "Date", "Close", "signal", INITIAL_MONEY, 1, 1, holdout_frac=0.0)


@register("ts.backtest_signal.abcd.cash", _signal_backtest_sql(SQL_SIG_ABCD + """,
sig AS (SELECT a.Name, a.Date, p.Close, a.rn, count(*) OVER (PARTITION BY a.Name) AS N, a.signal
        FROM abcd a JOIN prices p ON a.Name = p.Name AND a.Date = p.Date)""", 0.0) + f"""
SELECT p.Name, CAST(p.Date AS VARCHAR) AS Date,
       coalesce(last_value(t.cash IGNORE NULLS) OVER (PARTITION BY p.Name ORDER BY p.Date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {INITIAL_MONEY}) AS cash
FROM prices p LEFT JOIN trades t ON p.Name = t.Name AND CAST(p.Date AS VARCHAR) = t.Date""")
def ts_backtest_abcd_cash(spark, d):
    """The ABCD back-test's money log: cash at the end of every day."""
    p = prices(spark, d)
    trades = _abcd_trades(spark, d)
    return strategy.cash_by_day(trades, p, "Name", "Date", INITIAL_MONEY)


@register("ts.backtest_rolling", _rolling_backtest_sql(f"SELECT 0, 4, {INITIAL_MONEY}::DOUBLE") + """
SELECT b.Name, b.rn - 1 AS day, CAST(s.Date AS VARCHAR) AS Date, action, executed,
       CASE WHEN executed THEN 1.0 ELSE 0.0 END AS units, b.cur AS price, cash, inv AS inventory, invest_pct
FROM bt b JOIN s ON b.Name = s.Name AND b.rn = s.rn WHERE action IS NOT NULL""")
def ts_backtest_rolling(spark, d):
    """Signal-free delay strategy (delay 4, start in the buy state)."""
    return strategy.backtest_rolling(prices(spark, d), "Name", "Date", "Close", delay=4, initial_state=1,
                                     initial_money=INITIAL_MONEY)


# The parameter grid of the sweep (delays × starting cash).
SWEEP_GRID = [{"param_id": i * 2 + j, "delay": delay, "initial_money": money}
              for i, delay in enumerate(range(1, 7)) for j, money in enumerate((5000.0, 10000.0))]


def _sweep_sql():
    vals = " UNION ALL ".join(f"SELECT {g['param_id']}, {g['delay']}, {g['initial_money']}::DOUBLE" for g in SWEEP_GRID)
    return _rolling_backtest_sql(vals) + """,
res AS (SELECT Name, CAST(param_id AS BIGINT) AS param_id, CAST(delay AS BIGINT) AS delay, initial_money,
               count(action) AS n_trades, arg_max(cash, rn) - initial_money AS total_gains
        FROM bt GROUP BY Name, param_id, delay, initial_money)
SELECT *, row_number() OVER (PARTITION BY Name ORDER BY total_gains DESC, param_id) AS rank FROM res"""


@register("ts.param_sweep", _sweep_sql())
def ts_param_sweep(spark, d):
    return strategy.sweep(prices(spark, d), SWEEP_GRID, "Name", "Date", "Close")


@register("ts.knn_novelty", """
WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT q.vec_id, e.label < 5 AS backlog, list_distance(q.v, CAST(e.embedding AS DOUBLE[])) AS dist
      FROM q, embeddings e),
r AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id, backlog ORDER BY dist) <= 4),
m AS (SELECT vec_id, backlog, avg(dist) AS md FROM r GROUP BY 1, 2)
SELECT vec_id, round(sum(md), 6) AS novelty FROM m GROUP BY vec_id""")
def ts_knn_novelty(spark, d):
    e = table(spark, d, "embeddings")
    refs = {"backlog": e.filter(F.col("label") < 5), "population": e.filter(F.col("label") >= 5)}
    out = knn.knn_novelty(e, refs, "vec_id", "embedding", k=4)
    return out.withColumn("novelty", F.round("novelty", 6))
