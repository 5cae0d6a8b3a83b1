"""The price pipeline, reports, signals and a back-test over hundreds of symbols.

A symbol is a group of parts, its bars the line prices of a shipping day.  Many
of the 400 symbols are missing on a given day, and the top-50 cut of the
report really cuts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.money import dec
from tickframe.operators import strategy
from tickframe.operators import timeseries as ts
from tickframe.plans import series, strategies  # noqa: F401 - their oracles are looked up here
from tickframe.plans.aggregates import change_report
from tickframe.plans.prices import INGEST_DATE, SQL_BARS, SQL_PRICES
from tickframe.plans.registry import oracle, register
from tickframe.sources.tables import table

SYMBOLS = 400
TICK = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]

SQL_MANY_BARS = f"""
bars AS (
  SELECT concat('P', l_partkey % {SYMBOLS}) AS Name, CAST(l_shipdate AS DATE) AS Date,
         arg_min(l_extendedprice, ({', '.join(TICK)})) AS Open, max(l_extendedprice) AS High,
         min(l_extendedprice) AS Low, arg_max(l_extendedprice, ({', '.join(TICK)})) AS Close,
         CAST(count(*) AS DOUBLE) AS Volume
  FROM lineitem GROUP BY 1, 2)"""
_ONE = SQL_PRICES % {"ingest": INGEST_DATE}
_MANY = (SQL_PRICES % {"ingest": INGEST_DATE}).replace(SQL_BARS, SQL_MANY_BARS)


def _sql(name: str) -> str:
    """The oracle of a query over the three symbols, over many of them."""
    return oracle(name).replace(_ONE.strip(), _MANY.strip())


def prices(spark, d):
    li, tick = table(spark, d, "lineitem"), F.struct(*TICK)
    bars = li.groupBy(F.concat(F.lit("P"), (F.col("l_partkey") % SYMBOLS).cast("string")).alias("Name"), F.to_date("l_shipdate").alias("Date")).agg(
        F.min_by("l_extendedprice", tick).alias("Open"), F.max("l_extendedprice").alias("High"), F.min("l_extendedprice").alias("Low"),
        F.max_by("l_extendedprice", tick).alias("Close"), F.count(F.lit(1)).cast("double").alias("Volume"))
    return ts.build_prices(bars.withColumn("Adj Close", F.col("Close")), INGEST_DATE)


@register("ts.pipeline_backfill.many", _sql("ts.pipeline_backfill"))
def pipeline_many(spark, d):
    return prices(spark, d)


@register("agg.window_report.many", _sql("agg.window_report").replace("2001-08-01", "2001-11-04").replace("avg(change_in_percent), 2)", "avg(change_in_percent), 6)"))
def window_report_many(spark, d):
    """The 50 symbols with the largest average change of a month, of 400; six digits, as with two some
    averages lie halfway, where engines round differently."""
    return change_report(prices(spark, d), "2001-11-04", 30, digits=6)


@register("ts.ma_signal.many", _sql("ts.ma_signal"))
def ma_signal_many(spark, d):
    p = prices(spark, d).select("Name", "Date", dec("Close").alias("px"))
    return ts.ma_signal(p, "Name", "Date", "px").select("Name", "Date", "short_ma", "long_ma", "signal", "positions")


@register("ts.breakout_signal.many", _sql("ts.breakout_signal"))
def breakout_signal_many(spark, d):
    out = ts.breakout_signal(prices(spark, d), "Name", "Date", "Close", 0.1)
    return out.select("Name", "Date", "prior_max", "prior_min", "signal")


@register("ts.backtest_signal.many", _sql("ts.backtest_signal.summary"))
def backtest_many(spark, d):
    """Buys, sells and gains of the breakout strategy per symbol."""
    p = prices(spark, d)
    return strategy.summarize(strategies._turtle_trades(p), strategies._keys(p), "Name", strategies.INITIAL_MONEY)


@register("ts.risk_return.many", _sql("ts.risk_return"))
def risk_return_many(spark, d):
    from tickframe.operators import windows
    r = windows.pct_change(prices(spark, d), "Name", "Date", "Close", out="ret")
    return r.groupBy("Name").agg(F.round(F.avg("ret"), 9).alias("expected_return"),
                                 F.round(F.stddev_samp("ret"), 9).alias("risk"), F.count("ret").alias("n"))
