"""Ordered operators over raw rows whose keys each hold a large share of the table.

The queries cut keys of more than ``ROWS`` rows, so that keys are cut on small
tables as well; the bound on all pieces together raises it on large ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.money import NET, net
from tickframe.operators import pieces, windows
from tickframe.plans.registry import register
from tickframe.sources.tables import table

T = table
ROWS = 1024

SQL_LINES = f"""
WITH li AS (
  SELECT l_returnflag AS ch, l_shipdate AS d, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {NET} AS rev, l_quantity,
         l_partkey, l_suppkey, l_extendedprice
  FROM lineitem)"""
#: Line numbers repeat within an order, so the order goes on to what tells lines apart.
LINE_ORDER = ["d", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
SQL_LINE = f"PARTITION BY ch ORDER BY {', '.join(LINE_ORDER)}"


def _lines(spark, d):
    return T(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("ch"), F.col("l_shipdate").alias("d"), "l_orderkey", "l_linenumber", net().alias("rev"),
        "l_quantity", "l_partkey", "l_suppkey", "l_extendedprice")


@register("win.running_sum.hot", SQL_LINES + f"""
SELECT ch, l_orderkey, l_linenumber, CAST(sum(rev) OVER ({SQL_LINE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cume_rev
FROM li""")
def running_sum_hot(spark, d):
    """Revenue so far per channel after each line; three channels hold all lines."""
    out = windows.running(_lines(spark, d), "ch", LINE_ORDER, "rev", "sum", "cume_rev", split=ROWS)
    return out.select("ch", "l_orderkey", "l_linenumber", F.col("cume_rev").cast("double").alias("cume_rev"))


@register("win.running_max.hot", SQL_LINES + f"""
SELECT ch, l_orderkey, l_linenumber, CAST(max(rev) OVER ({SQL_LINE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS best_rev,
       count(rev) OVER ({SQL_LINE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
FROM li""")
def running_max_hot(spark, d):
    out = windows.running(_lines(spark, d), "ch", LINE_ORDER, "rev", "max", "best_rev", split=ROWS)
    out = windows.running(out, "ch", LINE_ORDER, "rev", "count", "n", split=ROWS)
    return out.select("ch", "l_orderkey", "l_linenumber", F.col("best_rev").cast("double").alias("best_rev"), "n")


@register("win.lag.hot", SQL_LINES + f"""
SELECT ch, l_orderkey, l_linenumber, CAST(lag(l_orderkey) OVER ({SQL_LINE}) AS DOUBLE) AS prev_orderkey,
       lag(l_quantity) OVER ({SQL_LINE}) AS prev_quantity
FROM li""")
def lag_hot(spark, d):
    out = windows.lag_split(_lines(spark, d), ["ch"], LINE_ORDER, ["l_orderkey", "l_quantity"], rows=ROWS)
    return out.select("ch", "l_orderkey", "l_linenumber", F.col("prev_l_orderkey").cast("double").alias("prev_orderkey"),
                      F.col("prev_l_quantity").alias("prev_quantity"))


SQL_TICKS = "PARTITION BY event_type ORDER BY ts, event_id"


def _ticks(spark, d):
    return T(spark, d, "events").select("event_type", "ts", "event_id", "value")


@register("win.gap.hot", f"""
WITH g AS (
  SELECT event_type, (epoch_us(ts) - epoch_us(lag(ts) OVER ({SQL_TICKS}))) // 1000000 AS gap_seconds FROM events)
SELECT event_type, round(avg(gap_seconds), 4) AS avg_gap_seconds, max(gap_seconds) AS max_gap_seconds, count(gap_seconds) AS n_gaps
FROM g GROUP BY event_type""")
def gap_hot(spark, d):
    """Silence between two events of a type; five types hold all events."""
    g = windows.idle_gap(_ticks(spark, d), "event_type", "ts", "ts", "event_id", rows=ROWS)
    return g.groupBy("event_type").agg(F.round(F.avg("gap_seconds"), 4).alias("avg_gap_seconds"),
                                       F.max("gap_seconds").alias("max_gap_seconds"), F.count("gap_seconds").alias("n_gaps"))


@register("win.rolling_mean.hot", f"""
SELECT event_id, event_type, round(avg(value) OVER ({SQL_TICKS} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS mean_5,
       CASE WHEN count(value) OVER ({SQL_TICKS} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) >= 100
            THEN round(avg(value) OVER ({SQL_TICKS} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) END AS mean_100
FROM events""")
def rolling_mean_hot(spark, d):
    e = windows.rolling(_ticks(spark, d), "event_type", ["ts", "event_id"], "value", "mean", 5, min_periods=1, out="mean_5", split=ROWS)
    e = windows.rolling(e, "event_type", ["ts", "event_id"], "value", "mean", 100, out="mean_100", split=ROWS)
    return e.select("event_id", "event_type", F.round("mean_5", 6).alias("mean_5"), F.round("mean_100", 6).alias("mean_100"))


@register("win.rolling_std.hot", f"""
SELECT event_id, event_type, CASE WHEN count(value) OVER w >= 30 THEN round(stddev_samp(value) OVER w, 6) END AS sd_30
FROM events WINDOW w AS ({SQL_TICKS} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_std_hot(spark, d):
    e = windows.rolling(_ticks(spark, d), "event_type", ["ts", "event_id"], "value", "std", 30, out="sd_30", split=ROWS)
    return e.select("event_id", "event_type", F.round("sd_30", 6).alias("sd_30"))


@register("win.rolling_extreme.hot", f"""
SELECT event_id, event_type, CASE WHEN count(value) OVER w = 50 THEN max(value) OVER w END AS prior_max,
       CASE WHEN count(value) OVER w = 50 THEN min(value) OVER w END AS prior_min
FROM events WINDOW w AS ({SQL_TICKS} ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""")
def rolling_extreme_hot(spark, d):
    e = windows.rolling(_ticks(spark, d), "event_type", ["ts", "event_id"], "value", "max", 50, shift=1, out="prior_max", split=ROWS)
    e = windows.rolling(e, "event_type", ["ts", "event_id"], "value", "min", 50, shift=1, out="prior_min", split=ROWS)
    return e.select("event_id", "event_type", "prior_max", "prior_min")


@register("ts.densify_ffill.hot", """
WITH e AS (SELECT event_id, user_id % 3 AS region, ts, CASE WHEN event_type = 'purchase' THEN value END AS paid FROM events)
SELECT event_id, CAST(region AS BIGINT) AS region,
       last_value(paid IGNORE NULLS) OVER (PARTITION BY region ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_paid
FROM e""")
def ffill_hot(spark, d):
    """The last price paid in a region as of each of its events; three regions hold all events."""
    e = T(spark, d, "events").select("event_id", (F.col("user_id") % 3).alias("region"), "ts",
                                     F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid"))
    out = pieces.running(e, "region", ["ts", "event_id"], "paid", "last", "last_paid", ROWS)
    return out.select("event_id", "region", "last_paid")


@register("ts.ewma.ticks", f"""
WITH RECURSIVE s AS (SELECT event_id, event_type, value, row_number() OVER ({SQL_TICKS}) AS rn FROM events),
e AS (SELECT event_type, rn, event_id, value AS y FROM s WHERE rn = 1
      UNION ALL
      SELECT s.event_type, s.rn, s.event_id, e.y * 0.9::DOUBLE + (1 - 0.9::DOUBLE) * s.value
      FROM e JOIN s ON s.event_type = e.event_type AND s.rn = e.rn + 1)
SELECT event_id, event_type, round(y, 6) AS ewma FROM e""")
def ewma_ticks(spark, d):
    """Smoothing over all ticks of a type instead of its daily bars."""
    e = _ticks(spark, d)
    x = F.col("value")
    out = pieces.affine(e, "event_type", ["ts", "event_id"], 0.9, x * (1 - 0.9), x, "ewma", ROWS)
    return out.select("event_id", "event_type", F.round("ewma", 6).alias("ewma"))


@register("src.as_of.many", """
WITH p AS (SELECT user_id, ts, event_id, value, false AS asks FROM events WHERE event_type = 'purchase'),
q AS (SELECT user_id, ts, event_id, NULL::DOUBLE AS value, true AS asks FROM events WHERE event_type = 'error'),
u AS (SELECT * FROM p UNION ALL SELECT * FROM q),
f AS (SELECT *, last_value(CASE WHEN NOT asks THEN event_id END IGNORE NULLS) OVER w AS paid_event,
             last_value(CASE WHEN NOT asks THEN value END IGNORE NULLS) OVER w AS paid
      FROM u WINDOW w AS (PARTITION BY user_id ORDER BY ts, asks, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, CAST(paid_event AS DOUBLE) AS paid_event, paid FROM f WHERE asks""")
def as_of_many(spark, d):
    """Each error with its user's last purchase as of that moment: as many as-of times as there are errors."""
    e = T(spark, d, "events")
    paid = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("paid_event"), F.col("value").alias("paid"))
    asks = e.filter("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("at"))
    out = pieces.as_of_many(paid, asks, "user_id", "ts", "at", tie=["paid_event"])
    return out.select("event_id", "user_id", F.col("paid_event").cast("double").alias("paid_event"), "paid")


@register("src.as_of.many.hot", """
WITH u AS (
  SELECT event_id, user_id % 2 AS half, ts, value, event_type = 'error' AS asks FROM events WHERE event_type IN ('purchase', 'error')),
f AS (SELECT *, last_value(CASE WHEN NOT asks THEN value END IGNORE NULLS) OVER (
               PARTITION BY half ORDER BY ts, asks, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS paid FROM u)
SELECT event_id, CAST(half AS BIGINT) AS half, paid FROM f WHERE asks""")
def as_of_many_hot(spark, d):
    """The same over two keys that hold all rows."""
    e = T(spark, d, "events").withColumn("half", F.col("user_id") % 2)
    paid = e.filter("event_type = 'purchase'").select("half", "ts", F.col("event_id").alias("paid_event"), F.col("value").alias("paid"))
    asks = e.filter("event_type = 'error'").select("event_id", "half", F.col("ts").alias("at"))
    return pieces.as_of_many(paid, asks, "half", "ts", "at", tie=["paid_event"], rows=ROWS).select("event_id", "half", "paid")
