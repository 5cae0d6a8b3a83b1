"""§2.10: the daily increment run as a stream over arriving month files.

The backfill (days before 2001) is stored first; the 2001 feed then arrives
as one raw file per month and the streaming job appends one partition per
micro-batch.  The changes it computes must equal the batch pipeline's, also when a
day comes in two files, a file comes late or is merged twice."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickframe.operators import timeseries as ts
from tickframe.plans.prices import CUT_DATE, INGEST_DATE, SQL_PRICES, raw_feed
from tickframe.plans.registry import register
from tickframe.session import scratch_path
from tickframe.streaming.daily import run_daily_stream, store_prices

RAW_SCHEMA = ("Name string, Date date, Open double, High double, Low double, Close double, "
              "`Adj Close` double, Volume double")


SQL_NEW_DAYS = "WITH " + SQL_PRICES % {"ingest": INGEST_DATE} + f"""
SELECT Name, CAST(Date AS VARCHAR) AS Date, Close, prev_close, change, change_in_percent
FROM prices WHERE Date >= DATE '{CUT_DATE}'"""


def streamed(spark, d, file_of, files, runs=1):
    """Store the days before the cut, let the others arrive as one file for each of
    ``files`` (the values of the column ``file_of``, in order of arrival), run the stream."""
    base = scratch_path(spark, f"stream/{uuid.uuid4().hex[:10]}")
    table_path, source = f"{base}/prices", f"{base}/incoming"
    raw = raw_feed(spark, d).select("Name", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")
    cut = F.lit(CUT_DATE).cast("date")
    store_prices(ts.build_prices(raw.filter(F.col("Date") < cut), "2000-12-31"), table_path)
    new = raw.filter(F.col("Date") >= cut).withColumn("file", file_of)
    for k, f in enumerate(files):
        new.filter(F.col("file") == f).drop("file").coalesce(1).write.parquet(f"{source}/{k:03d}")
    for k in range(runs):  # each run has a checkpoint of its own, so a later one replays every file
        run_daily_stream(spark, f"{source}/*", table_path, f"{base}/checkpoint{k}", RAW_SCHEMA)
    out = spark.read.parquet(table_path).filter(F.col("Date") >= cut)
    return out.select("Name", "Date", "Close", "prev_close", "change", "change_in_percent")


#: Months of arrival; what is dated after them arrives in one last file.
MONTHS = [f"2001-{m:02d}" for m in range(1, 8)]
LAST_FILE = "later"


@register("stream.daily_increment", SQL_NEW_DAYS)
def stream_daily_increment(spark, d):
    month = F.date_format("Date", "yyyy-MM")
    return streamed(spark, d, F.when(month.isin(MONTHS), month).otherwise(LAST_FILE), [*MONTHS, LAST_FILE])


@register("stream.two_files_one_day", SQL_NEW_DAYS)
def stream_two_files_one_day(spark, d):
    """All days arrive twice, in files of different symbols: the second file's
    symbols are absent from the last stored days."""
    return streamed(spark, d, F.when(F.col("Name") == "F", "b").otherwise("a"), ["a", "b"])


@register("stream.late_file", SQL_NEW_DAYS)
def stream_late_file(spark, d):
    """The file with the earlier days arrives last."""
    return streamed(spark, d, F.when(F.col("Date") < F.lit("2001-04-01").cast("date"), "early").otherwise("late"), ["late", "early"])


@register("stream.replayed", SQL_NEW_DAYS)
def stream_replayed(spark, d):
    """Every file is merged a second time, as after a crash before the commit."""
    return streamed(spark, d, F.lit("all"), ["all"], runs=2)
