"""§2.8 series, risk and strategy operators over the price bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.money import D, DAVG, dec, davg
from tickframe.operators import stats, strategy, timeseries as ts, windows
from tickframe.plans.prices import INGEST_DATE, SQL_PRICES, prices
from tickframe.plans.registry import register
from tickframe.sources.tables import table

T = table
PRICES = SQL_PRICES % {"ingest": INGEST_DATE}
PRICES_WITH = "WITH " + PRICES

SQL_DENSE = """,
span AS (SELECT Name, min(Date) AS lo, max(Date) AS hi FROM prices GROUP BY Name),
grid AS (SELECT Name, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date FROM span),
dense AS (SELECT g.Name, g.Date,
                 last_value(p.Close IGNORE NULLS) OVER (PARTITION BY g.Name ORDER BY g.Date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Close
          FROM grid g LEFT JOIN prices p ON g.Name = p.Name AND g.Date = p.Date)"""


@register("ts.densify_ffill", PRICES_WITH + SQL_DENSE + """
SELECT Name, CAST(Date AS VARCHAR) AS Date, Close FROM dense""")
def ts_densify(spark, d):
    return ts.densify(prices(spark, d), "Name", "Date", ["Close"])


@register("ts.returns_vol", PRICES_WITH + SQL_DENSE + """,
r AS (SELECT Name, Date, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS ret FROM dense)
SELECT Name, CAST(Date AS VARCHAR) AS Date, ret,
       CASE WHEN count(ret) OVER w >= 30 THEN round(stddev_samp(ret) OVER w, 9) END AS volatility
FROM r WINDOW w AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def ts_returns_vol(spark, d):
    out = ts.returns_vol(prices(spark, d), "Name", "Date", "Close", 30)
    return out.select("Name", "Date", "ret", F.round("volatility", 9).alias("volatility"))


@register("ts.sma_pair", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       CASE WHEN count(Close) OVER w5 = 5 THEN round(avg(Close) OVER w5, 4) END AS sma_5,
       CASE WHEN count(Close) OVER w30 = 30 THEN round(avg(Close) OVER w30, 4) END AS sma_30
FROM prices WINDOW w5 AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
                   w30 AS (PARTITION BY Name ORDER BY Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def ts_sma_pair(spark, d):
    out = ts.sma_pair(prices(spark, d), "Name", "Date", "Close", 5, 30)
    return out.select("Name", "Date", F.round("sma_5", 4).alias("sma_5"), F.round("sma_30", 4).alias("sma_30"))


SQL_NUMBERED = """,
s AS (SELECT Name, Date, Close, row_number() OVER (PARTITION BY Name ORDER BY Date) AS rn,
             count(*) OVER (PARTITION BY Name) AS N,
             sum(CAST(Close AS DECIMAL(18,2))) OVER (PARTITION BY Name ORDER BY Date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs
      FROM prices)"""


@register("ts.ma_signal", PRICES_WITH + SQL_NUMBERED + """,
k AS (SELECT *, greatest(1, CAST(floor(N * 0.025::DOUBLE) AS BIGINT)) AS ns,
                greatest(1, CAST(floor(N * 0.05::DOUBLE) AS BIGINT)) AS nl FROM s),
m AS (SELECT k.*, CAST(k.cs - coalesce(a.cs, 0) AS DOUBLE) / least(k.ns, k.rn) AS short_ma,
             CAST(k.cs - coalesce(b.cs, 0) AS DOUBLE) / least(k.nl, k.rn) AS long_ma
      FROM k LEFT JOIN s a ON a.Name = k.Name AND a.rn = k.rn - k.ns
             LEFT JOIN s b ON b.Name = k.Name AND b.rn = k.rn - k.nl),
g AS (SELECT *, CASE WHEN rn - 1 >= ns AND short_ma > long_ma THEN 1.0 ELSE 0.0 END AS signal FROM m)
SELECT Name, CAST(Date AS VARCHAR) AS Date, short_ma, long_ma, signal,
       signal - lag(signal) OVER (PARTITION BY Name ORDER BY Date) AS positions FROM g""")
def ts_ma_signal(spark, d):
    p = prices(spark, d).select("Name", "Date", dec("Close").alias("px"))
    out = ts.ma_signal(p, "Name", "Date", "px")
    # exact prefix sums over DECIMAL: the averages need no rounding to compare
    return out.select("Name", "Date", "short_ma", "long_ma", "signal", "positions")


@register("ts.breakout_signal", PRICES_WITH + SQL_NUMBERED + """,
k AS (SELECT *, CAST(ceil(N * 0.1::DOUBLE) AS BIGINT) AS win FROM s),
r AS (SELECT k.Name, k.Date, k.Close, k.rn, k.win, max(p.Close) AS mx, min(p.Close) AS mn, count(p.Close) AS c
      FROM k LEFT JOIN s p ON p.Name = k.Name AND p.rn BETWEEN k.rn - k.win AND k.rn - 1
      GROUP BY k.Name, k.Date, k.Close, k.rn, k.win)
SELECT Name, CAST(Date AS VARCHAR) AS Date, CASE WHEN c = win THEN mx END AS prior_max,
       CASE WHEN c = win THEN mn END AS prior_min,
       CASE WHEN c = win AND mn > Close THEN 1.0 WHEN c = win AND mx < Close THEN -1.0 ELSE 0.0 END AS signal FROM r""")
def ts_breakout_signal(spark, d):
    out = ts.breakout_signal(prices(spark, d), "Name", "Date", "Close", 0.1)
    return out.select("Name", "Date", "prior_max", "prior_min", "signal")


# The smoothing weights of the forecast notebooks.
EWMA_WEIGHTS = (0.3, 0.4, 0.7)


def _ewma_sql(w):
    a = repr(1 - w)
    return "WITH RECURSIVE " + PRICES + f""",
s AS (SELECT Name, Date, Close, row_number() OVER (PARTITION BY Name ORDER BY Date) AS rn FROM prices),
e AS (SELECT Name, rn, Date, Close * {w}::DOUBLE + {a}::DOUBLE * Close AS y FROM s WHERE rn = 1
      UNION ALL
      SELECT s.Name, s.rn, s.Date, e.y * {w}::DOUBLE + {a}::DOUBLE * s.Close FROM e JOIN s ON s.Name = e.Name AND s.rn = e.rn + 1)
SELECT Name, CAST(Date AS VARCHAR) AS Date, round(y, 6) AS ewma FROM e"""


@register("ts.ewma", _ewma_sql(0.3))
def ts_ewma(spark, d):
    out = strategy.ewma(prices(spark, d), "Name", "Date", "Close", 0.3)
    return out.withColumn("ewma", F.round("ewma", 6))


@register("ts.ewma.w04", _ewma_sql(0.4))
def ts_ewma_04(spark, d):
    out = strategy.ewma(prices(spark, d), "Name", "Date", "Close", 0.4)
    return out.withColumn("ewma", F.round("ewma", 6))


@register("ts.ewma.w07", _ewma_sql(0.7))
def ts_ewma_07(spark, d):
    out = strategy.ewma(prices(spark, d), "Name", "Date", "Close", 0.7)
    return out.withColumn("ewma", F.round("ewma", 6))


@register("ts.discounted_sum", "WITH RECURSIVE " + PRICES + """,
s AS (SELECT Name, Date, change, row_number() OVER (PARTITION BY Name ORDER BY Date DESC) AS rb FROM prices),
e AS (SELECT Name, rb, Date, 0.0::DOUBLE * 0.9::DOUBLE + change AS R FROM s WHERE rb = 1
      UNION ALL
      SELECT s.Name, s.rb, s.Date, e.R * 0.9::DOUBLE + s.change FROM e JOIN s ON s.Name = e.Name AND s.rb = e.rb + 1)
SELECT Name, CAST(Date AS VARCHAR) AS Date, round(R, 6) AS discounted FROM e""")
def ts_discounted_sum(spark, d):
    out = strategy.discounted_sum(prices(spark, d), "Name", "Date", "change", 0.9)
    return out.withColumn("discounted", F.round("discounted", 6))


SQL_FORECAST = """,
f AS (SELECT Name, Date, Close,
             avg(Close) OVER (PARTITION BY Name ORDER BY Date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS pred
      FROM prices)"""


@register("ts.accuracy", PRICES_WITH + SQL_FORECAST + """
SELECT Name, round((1 - sqrt(avg(pow((Close - pred) / (Close + 1), 2)))) * 100, 9) AS accuracy
FROM f WHERE pred IS NOT NULL GROUP BY Name""")
def ts_accuracy(spark, d):
    f = windows.rolling(prices(spark, d), "Name", "Date", "Close", "mean", 5, min_periods=1, shift=1, out="pred")
    a = ts.accuracy(f.filter(F.col("pred").isNotNull()), "Close", "pred", ["Name"])
    return a.withColumn("accuracy", F.round("accuracy", 9))


@register("ts.forecast_filter", PRICES_WITH + """,
runs AS (
  SELECT Name, Date, 'sma_5' AS run, avg(Close) OVER (PARTITION BY Name ORDER BY Date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS v FROM prices
  UNION ALL SELECT Name, Date, 'sma_20', avg(Close) OVER (PARTITION BY Name ORDER BY Date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) FROM prices
  UNION ALL SELECT Name, Date, 'scaled_3x', Close * 3 FROM prices),
held AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY Name, run ORDER BY Date DESC) <= 30),
rng AS (SELECT Name, min(Close) AS lo, max(Close) AS hi FROM prices GROUP BY Name)
SELECT h.Name, run, bool_and(v >= lo AND v <= 2 * hi) AS accepted FROM held h JOIN rng r ON h.Name = r.Name
GROUP BY h.Name, run""")
def ts_forecast_filter(spark, d):
    p = prices(spark, d).select("Name", "Date", "Close")
    r5 = windows.rolling(p, "Name", "Date", "Close", "mean", 5, min_periods=1, out="v").withColumn("run", F.lit("sma_5"))
    r20 = windows.rolling(p, "Name", "Date", "Close", "mean", 20, min_periods=1, out="v").withColumn("run", F.lit("sma_20"))
    r3 = p.withColumn("v", F.col("Close") * 3).withColumn("run", F.lit("scaled_3x"))
    runs = r5.unionByName(r20).unionByName(r3)
    return ts.accept_forecasts(runs, p, "Name", "Date", "run", "v", "Close", holdout=30)


@register("ts.minmax_scale", PRICES_WITH + """
SELECT Name, CAST(Date AS VARCHAR) AS Date,
       round((Close - min(Close) OVER (PARTITION BY Name)) / (max(Close) OVER (PARTITION BY Name)
             - min(Close) OVER (PARTITION BY Name)), 9) AS scaled FROM prices""")
def ts_minmax(spark, d):
    out = ts.minmax(prices(spark, d).select("Name", "Date", "Close"), "Name", "Close")
    return out.select("Name", "Date", F.round("scaled", 9).alias("scaled"))


@register("ts.minmax_scale.inverse", PRICES_WITH + """,
sc AS (SELECT Name, Date, Close, min(Close) OVER (PARTITION BY Name) AS mn, max(Close) OVER (PARTITION BY Name) AS mx
       FROM prices)
SELECT Name, CAST(Date AS VARCHAR) AS Date, round((Close - mn) / (mx - mn) * (mx - mn) + mn, 6) AS restored FROM sc""")
def ts_minmax_inverse(spark, d):
    """Scale each series to [0, 1], then map it back with the per-series range."""
    p = prices(spark, d).select("Name", "Date", "Close")
    scaled = ts.minmax(p, "Name", "Close")
    ranges = p.groupBy("Name").agg(F.min("Close").alias("min"), F.max("Close").alias("max"))
    back = ts.minmax_inverse(scaled, ranges, "Name", "scaled", "restored")
    return back.select("Name", "Date", F.round("restored", 6).alias("restored"))


SQL_SENTIMENT = f"""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS d, {DAVG(D('value'))} AS close,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) / count(*) AS positive,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / count(*) AS negative
  FROM events GROUP BY 1)"""


@register("ts.scenario", SQL_SENTIMENT + """
SELECT 'original' AS scenario, CAST(d AS VARCHAR) AS d, close, positive, negative FROM daily
UNION ALL SELECT 'negative', CAST(d AS VARCHAR), close, 0.0, 1.0 FROM daily
UNION ALL SELECT 'positive', CAST(d AS VARCHAR), close, 1.0, 0.0 FROM daily""")
def ts_scenario(spark, d):
    e = T(spark, d, "events")
    n = F.count(F.lit(1))
    daily = e.groupBy(F.to_date("ts").alias("d")).agg(
        davg("value").alias("close"),
        (F.count(F.when(F.col("event_type") == "purchase", 1)).cast("double") / n).alias("positive"),
        (F.count(F.when(F.col("event_type") == "error", 1)).cast("double") / n).alias("negative"))
    return ts.scenarios(daily, {"negative": {"positive": 0.0, "negative": 1.0},
                                "positive": {"positive": 1.0, "negative": 0.0}})


SQL_RETURNS = """,
r AS (SELECT Name, Date, Close, Close / lag(Close) OVER (PARTITION BY Name ORDER BY Date) - 1 AS ret FROM prices)"""


def _returns(spark, d):
    return windows.pct_change(prices(spark, d), "Name", "Date", "Close", out="ret")


@register("ts.var_bootstrap", PRICES_WITH + SQL_RETURNS + """
SELECT Name, round(quantile_cont(ret, 0.05), 9) AS var_quantile, count(ret) AS n_returns FROM r GROUP BY Name""")
def ts_var_bootstrap(spark, d):
    v = stats.var_hist(_returns(spark, d), "Name", "ret", 0.05)
    return v.withColumn("var_quantile", F.round("var_quantile", 9))


@register("ts.risk_return", PRICES_WITH + SQL_RETURNS + """
SELECT Name, round(avg(ret), 9) AS expected_return, round(stddev_samp(ret), 9) AS risk, count(ret) AS n FROM r
GROUP BY Name""")
def ts_risk_return(spark, d):
    r = _returns(spark, d)
    return r.groupBy("Name").agg(F.round(F.avg("ret"), 9).alias("expected_return"),
                                 F.round(F.stddev_samp("ret"), 9).alias("risk"), F.count("ret").alias("n"))


@register("ts.var_montecarlo", PRICES_WITH + SQL_RETURNS + """,
st AS (SELECT Name, avg(ret) AS mu, stddev_samp(ret) AS sigma, arg_max(Close, Date) AS start FROM r GROUP BY Name),
walk AS (
  SELECT Name, start, mu, sigma, run, md5(concat('42|', Name, '|', run, '|', step)) AS h
  FROM st, (SELECT unnest(range(10000)) AS run), (SELECT unnest(range(1, 365)) AS step)),
z AS (
  SELECT Name, start, mu, sigma, run,
         sqrt(-2 * ln((('0x' || substr(h, 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE))
           * cos(2 * pi() * ((('0x' || substr(h, 14, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE)) AS n
  FROM walk),
f AS (SELECT Name, start, run, start * product(1 + 2 * mu * (1.0::DOUBLE / 365) + sigma * sqrt(1.0::DOUBLE / 365) * n) AS final_price
      FROM z GROUP BY Name, start, run)
SELECT Name, start, round(avg(final_price), 4) AS mean_final, round(quantile_cont(final_price, 0.01), 4) AS q_final,
       round(start - quantile_cont(final_price, 0.01), 4) AS var
FROM f GROUP BY Name, start""")
def ts_var_montecarlo(spark, d):
    """Random walk per symbol and run, drawn by a hash of (seed, symbol, run, step)."""
    r = _returns(spark, d)
    st = r.groupBy("Name").agg(F.avg("ret").alias("mu"), F.stddev_samp("ret").alias("sigma"),
                               F.max_by("Close", "Date").alias("start"))
    out = stats.var_mc(st, "Name", "start", "mu", "sigma", days=365, runs=10000, seed=42, q=0.01)
    return out.select("Name", "start", *[F.round(c, 4).alias(c) for c in ("mean_final", "q_final", "var")])
