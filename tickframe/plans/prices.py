"""Daily price pipeline queries (the reference's central computation).

Stand-in data: daily bars from ``orders`` (Name = order status).  The raw
feed repeats one symbol, as the reference's undeduplicated symbol list does,
so dedup has work to do.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import timeseries as ts
from tickframe.operators import windows
from tickframe.plans.registry import register
from tickframe.sources.tables import table

INGEST_DATE = "2001-08-02"
CUT_DATE = "2001-01-01"

# DuckDB pieces shared by the oracles below
SQL_BARS = """
bars AS (
  SELECT o_orderstatus AS Name, CAST(o_orderdate AS DATE) AS Date,
         arg_min(o_totalprice, o_orderkey) AS Open, max(o_totalprice) AS High,
         min(o_totalprice) AS Low, arg_max(o_totalprice, o_orderkey) AS Close,
         CAST(count(*) AS DOUBLE) AS Volume
  FROM orders GROUP BY 1, 2)"""

SQL_PRICES = SQL_BARS + """,
raw AS (SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE Name = 'O'),
dedup AS (SELECT * FROM raw
          QUALIFY row_number() OVER (PARTITION BY Date, Name ORDER BY Open, High, Low, Close, Volume) = 1),
clean AS (
  SELECT Name, Date, round_even(Open, 2) AS Open, round_even(Close, 2) AS Close,
         round_even(Low, 2) AS Low, round_even(High, 2) AS High, round_even(Close, 2) AS AdjClose,
         round_even(Volume, 2) AS Volume, DATE '%(ingest)s' AS record_ingestion_date
  FROM dedup WHERE NOT isnan(Open)),
lagged AS (SELECT *, lag(Close) OVER (PARTITION BY Name ORDER BY Date) AS prev_close FROM clean),
changed AS (SELECT *, CASE WHEN Close - prev_close IS NULL THEN 0.0
                          ELSE round(Close - prev_close, 2) END AS change FROM lagged),
prices AS (SELECT *, round(change / prev_close * 100, 2) AS change_in_percent FROM changed)"""


def raw_feed(spark, sf_dir):
    bars = ts.order_bars(table(spark, sf_dir, "orders"))
    return bars.unionByName(bars.filter(F.col("Name") == "O"))


def prices(spark, sf_dir, ingest_date=INGEST_DATE):
    return ts.build_prices(raw_feed(spark, sf_dir), ingest_date)


@register("ts.pipeline_backfill", "WITH " + SQL_PRICES % {"ingest": INGEST_DATE} + """
SELECT * REPLACE (CAST(Date AS VARCHAR) AS Date,
                  CAST(record_ingestion_date AS VARCHAR) AS record_ingestion_date) FROM prices""")
def q_pipeline_backfill(spark, sf_dir):
    return prices(spark, sf_dir)


@register("win.change", "WITH " + SQL_PRICES % {"ingest": INGEST_DATE} + """
SELECT Name, CAST(Date AS VARCHAR) AS Date, Close, prev_close, change, change_in_percent FROM prices""")
def q_win_change(spark, sf_dir):
    return prices(spark, sf_dir).select("Name", "Date", "Close", "prev_close", "change", "change_in_percent")


@register("ts.pipeline_daily", "WITH " + SQL_PRICES % {"ingest": INGEST_DATE} + f"""
SELECT Name, CAST(Date AS VARCHAR) AS Date, Open, Close, Low, High, AdjClose, Volume,
       '{INGEST_DATE}' AS record_ingestion_date, prev_close, change, change_in_percent
FROM prices WHERE Date >= DATE '{CUT_DATE}'""")
def q_pipeline_daily(spark, sf_dir):
    raw = raw_feed(spark, sf_dir)
    stored = ts.build_prices(raw.filter(F.col("Date") < F.lit(CUT_DATE).cast("date")), "2000-12-31")
    new_day = raw.filter(F.col("Date") >= F.lit(CUT_DATE).cast("date"))
    return ts.increment_prices(new_day, stored, INGEST_DATE)


@register("src.latest_snapshot", """
WITH t AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS record_ingestion_date FROM orders)
SELECT o_orderkey, o_orderstatus, CAST(record_ingestion_date AS VARCHAR) AS record_ingestion_date
FROM t WHERE record_ingestion_date = (SELECT max(record_ingestion_date) FROM t)""")
def q_latest_snapshot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("record_ingestion_date"))
    return ts.latest_snapshot(o, "record_ingestion_date")


@register("clean.dedup", "WITH " + SQL_BARS + """
, raw AS (SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE Name = 'O')
SELECT Name, CAST(Date AS VARCHAR) AS Date, min(Open) AS Open, min(Close) AS Close, count(*) AS copies
FROM raw GROUP BY Name, Date""")
def q_dedup(spark, sf_dir):
    from tickframe.operators import clean
    raw = raw_feed(spark, sf_dir)
    copies = raw.groupBy("Name", "Date").agg(F.count(F.lit(1)).alias("copies"))
    return clean.dedup(raw, ["Date", "Name"]).join(copies, ["Name", "Date"]).select(
        "Name", "Date", "Open", "Close", "copies")


@register("win.lag", """
SELECT o_custkey, o_orderkey, o_orderdate,
       CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE)
         AS prev_orderkey
FROM orders""")
def q_win_lag(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    out = windows.lag_split(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey"])
    # nullable key as DOUBLE so NULLs read back the same in every client
    return out.withColumn("prev_orderkey", F.col("prev_o_orderkey").cast("double")).drop("prev_o_orderkey")


@register("win.gap", """
WITH g AS (
  SELECT event_type,
         (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) // 1000000 AS gap_seconds
  FROM events)
SELECT event_type, round(avg(gap_seconds), 4) AS avg_gap_seconds, count(gap_seconds) AS n_gaps
FROM g GROUP BY event_type ORDER BY avg_gap_seconds, event_type LIMIT 5""")
def q_win_gap(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    g = windows.idle_gap(e, "user_id", "ts", "ts", "event_id")
    return (g.groupBy("event_type")
             .agg(F.round(F.avg("gap_seconds"), 4).alias("avg_gap_seconds"),
                  F.count("gap_seconds").alias("n_gaps"))
             .orderBy("avg_gap_seconds", "event_type").limit(5))


SQL_EVENT_PRICES = """
bars AS (
  SELECT event_type AS Name, CAST(ts AS DATE) AS Date,
         arg_min(value, (ts, event_id)) AS Open, max(value) AS High, min(value) AS Low,
         arg_max(value, (ts, event_id)) AS Close, CAST(count(*) AS DOUBLE) AS Volume
  FROM events GROUP BY 1, 2),
clean AS (
  SELECT Name, Date, round_even(Open, 2) AS Open, round_even(Close, 2) AS Close, round_even(Low, 2) AS Low,
         round_even(High, 2) AS High, round_even(Close, 2) AS AdjClose, round_even(Volume, 2) AS Volume,
         DATE '2024-01-31' AS record_ingestion_date
  FROM bars WHERE NOT isnan(Open)),
lagged AS (SELECT *, lag(Close) OVER (PARTITION BY Name ORDER BY Date) AS prev_close FROM clean),
changed AS (SELECT *, CASE WHEN Close - prev_close IS NULL THEN 0.0
                          ELSE round(Close - prev_close, 2) END AS change FROM lagged),
prices AS (SELECT *, round(change / prev_close * 100, 2) AS change_in_percent FROM changed)"""


@register("ts.pipeline_backfill.events", "WITH " + SQL_EVENT_PRICES + """
SELECT * REPLACE (CAST(Date AS VARCHAR) AS Date,
                  CAST(record_ingestion_date AS VARCHAR) AS record_ingestion_date) FROM prices""")
def q_pipeline_backfill_events(spark, sf_dir):
    """The same pipeline over the second stand-in series: event-type bars
    whose open / close are the first / last tick of the day by (ts, event_id)."""
    return ts.build_prices(ts.event_bars(table(spark, sf_dir, "events")), "2024-01-31")
