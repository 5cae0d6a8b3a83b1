"""Series operators (ts.*): bars, the price pipelines, densify, signals.

Series operators work on bars: one row per (key, day).  The per-key row
count is bounded by the calendar, not by the raw data volume, so windows
partitioned by the key are cheap even when one key owns a large share of the
raw rows (the raw rows are collapsed by partial aggregation first).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.relational import null_safe_join
from tickframe.operators import clean, pieces, windows

PRICE_COLS = ["Name", "Date", "Open", "Close", "Low", "High", "AdjClose", "Volume",
              "record_ingestion_date"]


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# ---------------------------------------------------------------- bars

def order_bars(orders: DataFrame) -> DataFrame:
    """Daily bars from ``orders``: Name = order status, one bar per day.

    Open/Close are the first/last order of the day by order key.  Raw column
    names follow the download feed (``Adj Close``)."""
    return (orders
            .groupBy(F.col("o_orderstatus").alias("Name"), F.to_date("o_orderdate").alias("Date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("Open"),
                 F.max("o_totalprice").alias("High"),
                 F.min("o_totalprice").alias("Low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("Close"),
                 F.count(F.lit(1)).cast("double").alias("Volume"))
            .withColumn("Adj Close", F.col("Close")))


def event_bars(events: DataFrame) -> DataFrame:
    """Daily bars from ``events``: Name = event type, ticks ordered by (ts, event_id)."""
    tick = F.struct("ts", "event_id")
    return (events
            .groupBy(F.col("event_type").alias("Name"), F.to_date("ts").alias("Date"))
            .agg(F.min_by("value", tick).alias("Open"),
                 F.max("value").alias("High"),
                 F.min("value").alias("Low"),
                 F.max_by("value", tick).alias("Close"),
                 F.count(F.lit(1)).cast("double").alias("Volume"))
            .withColumn("Adj Close", F.col("Close")))


# ---------------------------------------------------------------- pipelines

def clean_prices(raw: DataFrame, ingest_date) -> DataFrame:
    """Raw feed → canonical ``daily_prices`` columns (no lag yet).

    dedup on (Date, Name) → drop NaN Open → rename → ingestion date →
    half-even rounding to 2 places → fixed column order."""
    d = clean.dedup(raw, ["Date", "Name"])
    d = clean.drop_nan(d, "Open")
    d = (d.withColumnRenamed("Adj Close", "AdjClose")
          .withColumn("record_ingestion_date", F.lit(_as_date(ingest_date)))
          .withColumn("Date", F.to_date("Date")))
    d = d.withColumns({c: F.bround(F.col(c).cast("double"), 2)
                       for c in ["Open", "High", "Low", "Close", "AdjClose", "Volume"]})
    return d.select(*PRICE_COLS)


def build_prices(raw: DataFrame, ingest_date) -> DataFrame:
    """ts.pipeline_backfill: cleaned prices with prev_close / change / change_in_percent."""
    return windows.lag_change(clean_prices(raw, ingest_date))


def latest_snapshot(df: DataFrame, date_col: str = "record_ingestion_date") -> DataFrame:
    """src.latest_snapshot: rows whose ``date_col`` equals the table maximum.

    The maximum is an uncorrelated scalar subquery, evaluated before the scan,
    so a table partitioned by ``date_col`` reads one partition only."""
    mx = df.select(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == mx)


def increment_prices(raw_day: DataFrame, stored: DataFrame, run_date) -> DataFrame:
    """ts.pipeline_daily: the rows of ``raw_day`` with their changes, stamped
    with ``run_date``, and the stored rows whose change they alter.

    Per symbol, what counts as history is its last stored row before its first
    new day, so a rerun doesn't take its own rows for history and a symbol
    missing from the last snapshot has one.  Of the stored rows from that day on
    only the one after a new row has another change than before; it is computed
    again and keeps its own ingestion date."""
    new = clean_prices(raw_day, run_date)
    first = new.groupBy("Name").agg(F.min("Date").alias("__first"))
    touched = null_safe_join(stored.select(*PRICE_COLS), first, "Name")
    before = F.col("Date") < F.col("__first")
    last = touched.filter(before).groupBy("Name").agg(F.max_by(F.struct(*PRICE_COLS), "Date").alias("r")).select("r.*")
    later = null_safe_join(touched.filter(~before).select(*PRICE_COLS), new.select("Name", "Date"), ["Name", "Date"], "left_anti")
    tag, after = "__new", "__after_new"
    merged = (new.withColumn(tag, F.lit(True))
                 .unionByName(later.withColumn(tag, F.lit(False)))
                 .unionByName(last.withColumn(tag, F.lit(False))))
    merged = merged.withColumn(after, F.lag(tag).over(Window.partitionBy("Name").orderBy("Date")))
    return windows.lag_change(merged).filter(F.col(tag) | F.coalesce(after, F.lit(False))).drop(tag, after)


def _as_date(d):
    if isinstance(d, str):
        return _dt.date.fromisoformat(d)
    return d


# ---------------------------------------------------------------- calendar

def densify(df: DataFrame, key: str, date: str, values: Sequence[str], split: int | None = None) -> DataFrame:
    """ts.densify_ffill: one row per key and calendar day from the key's first
    to last day; missing days carry the last known values forward.  With
    ``split``, a key with more days than that is filled range by range."""
    span = df.groupBy(key).agg(F.min(date).alias("__lo"), F.max(date).alias("__hi"))
    grid = span.select(key, F.explode(F.sequence("__lo", "__hi")).alias(date))
    j = null_safe_join(grid, df.select(key, date, *values), [key, date], "left")
    if split is not None:
        for v in values:
            j = pieces.running(j, key, date, v, "last", v, split)
        return j.select(key, date, *values)
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(key, date, *[F.last(v, ignorenulls=True).over(w).alias(v) for v in values])


def returns_vol(df: DataFrame, key: str, date: str, value: str, window: int = 30) -> DataFrame:
    """ts.returns_vol: densify → percentage change → rolling sample std (min = window)."""
    d = densify(df, key, date, [value])
    d = windows.pct_change(d, key, date, value, out="ret")
    return windows.rolling(d, key, date, "ret", "std", window, out="volatility")


def sma_pair(df: DataFrame, key: str, order: str, value: str, short: int = 5, long: int = 30) -> DataFrame:
    """ts.sma_pair: short and long simple moving averages, full windows only."""
    d = windows.rolling(df, key, order, value, "mean", short, out=f"sma_{short}")
    return windows.rolling(d, key, order, value, "mean", long, out=f"sma_{long}")


def _numbered(df: DataFrame, key: str, order) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*_cols(order))
    wall = Window.partitionBy(key)
    return df.withColumn("__rn", F.row_number().over(w)).withColumn("__N", F.count(F.lit(1)).over(wall))


def _mean_last_n(d: DataFrame, key: str, value: str, n_col: str, out: str) -> DataFrame:
    """Mean of the last ``n_col`` rows (``min_periods=1``) where the frame
    length differs per key: prefix sums + an equi-join on (key, row number),
    so no frame size has to be a literal."""
    # a DECIMAL value column gives exact prefix sums (independent of summation order)
    w = Window.partitionBy(key).orderBy("__rn").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__cs", F.sum(value).over(w))
    back = d.select(F.col(key).alias("__k"), F.col("__rn").alias("__rb"), F.col("__cs").alias("__csb"))
    j = d.join(back, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__rb") == F.col("__rn") - F.col(n_col)), "left")
    cnt = F.least(F.col(n_col), F.col("__rn"))
    total = (F.col("__cs") - F.coalesce("__csb", F.lit(0))).cast("double")
    return j.withColumn(out, total / cnt).drop("__k", "__rb", "__csb", "__cs")


def ma_signal(df: DataFrame, key: str, order: str, price: str,
              short_frac: float = 0.025, long_frac: float = 0.05) -> DataFrame:
    """ts.ma_signal: short/long moving averages with windows int(frac·N)
    (at least 1, N = rows of the key), signal 1 where short > long from row
    ``short`` on, else 0; ``positions`` = signal − previous signal."""
    d = _numbered(df, key, order)
    d = d.withColumn("__ns", F.greatest(F.lit(1), F.floor(F.col("__N") * short_frac).cast("int")))
    d = d.withColumn("__nl", F.greatest(F.lit(1), F.floor(F.col("__N") * long_frac).cast("int")))
    d = _mean_last_n(d, key, price, "__ns", "short_ma")
    d = _mean_last_n(d, key, price, "__nl", "long_ma")
    sig = F.when((F.col("__rn") - 1 >= F.col("__ns")) & (F.col("short_ma") > F.col("long_ma")), 1.0).otherwise(0.0)
    d = d.withColumn("signal", sig)
    w = Window.partitionBy(key).orderBy("__rn")
    d = d.withColumn("positions", F.col("signal") - F.lag("signal").over(w))
    return d.drop("__rn", "__N", "__ns", "__nl")


def breakout_signal(df: DataFrame, key: str, order: str, price: str, frac: float = 0.1) -> DataFrame:
    """ts.breakout_signal: n = ceil(frac·N); −1 when the max of the previous n
    prices is below the price, +1 when their min is above it, else 0.

    The per-key frame length n is not a literal, so the max/min over the n
    previous rows uses blocks of n rows: prefix extremes inside a block plus
    suffix extremes inside a block cover any n consecutive rows.  Windows are
    per (key, block); the suffix value n rows back is fetched by an equi-join
    on (key, row number)."""
    d = _numbered(df, key, order)
    d = d.withColumn("__win", F.ceil(F.col("__N") * frac).cast("long"))
    d = d.withColumn("__blk", F.floor((F.col("__rn") - 1) / F.col("__win")))
    wp = Window.partitionBy(key, "__blk").orderBy("__rn").rowsBetween(Window.unboundedPreceding, 0)
    ws = Window.partitionBy(key, "__blk").orderBy("__rn").rowsBetween(0, Window.unboundedFollowing)
    d = d.select("*", F.max(price).over(wp).alias("__pmax"), F.min(price).over(wp).alias("__pmin"),
                 F.max(price).over(ws).alias("__smax"), F.min(price).over(ws).alias("__smin"))
    w = Window.partitionBy(key).orderBy("__rn")
    d = d.withColumn("__pmax1", F.lag("__pmax").over(w)).withColumn("__pmin1", F.lag("__pmin").over(w))
    back = d.select(F.col(key).alias("__k"), F.col("__rn").alias("__rb"),
                    F.col("__smax").alias("__smaxb"), F.col("__smin").alias("__sminb"))
    j = d.join(back, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__rb") == F.col("__rn") - F.col("__win")), "left")
    j = j.withColumn("prior_max", F.greatest("__smaxb", "__pmax1")).withColumn(
        "prior_min", F.least("__sminb", "__pmin1"))
    # greatest/least skip NULLs: require the full frame (row number > n)
    full = F.col("__rn") > F.col("__win")
    j = j.withColumn("prior_max", F.when(full, F.col("prior_max"))).withColumn(
        "prior_min", F.when(full, F.col("prior_min")))
    sig = (F.when(F.col("prior_min") > F.col(price), 1.0)
            .when(F.col("prior_max") < F.col(price), -1.0).otherwise(0.0))
    return j.withColumn("signal", sig).drop(*[c for c in j.columns if c.startswith("__")])


# ---------------------------------------------------------------- scoring helpers

def accuracy(df: DataFrame, real: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """ts.accuracy: (1 − sqrt(mean(((r−p)/(r+1))²)))·100 per group."""
    e = F.pow((F.col(real) - F.col(pred)) / (F.col(real) + 1), 2)
    return df.groupBy(*by).agg(((1 - F.sqrt(F.avg(e))) * 100).alias("accuracy"))


def minmax(df: DataFrame, key: str, value: str, out: str = "scaled") -> DataFrame:
    """ts.minmax_scale: (x − min)/(max − min) per series; min and max come from
    a partial aggregate joined back (no window holding a whole key)."""
    mm = df.groupBy(key).agg(F.min(value).alias("__mn"), F.max(value).alias("__mx"))
    j = null_safe_join(df, mm, key)
    return j.withColumn(out, F.try_divide(F.col(value) - F.col("__mn"), F.col("__mx") - F.col("__mn"))) \
            .drop("__mn", "__mx")


def minmax_inverse(scaled: DataFrame, ranges: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Inverse of ``minmax`` with the per-key (min, max) table ``ranges``."""
    j = null_safe_join(scaled, ranges, key)
    return j.withColumn(out, F.col(value) * (F.col("max") - F.col("min")) + F.col("min"))


def scenarios(df: DataFrame, variants: Mapping[str, Mapping[str, object]], tag: str = "scenario") -> DataFrame:
    """ts.scenario: the original rows plus one copy per named variant with
    some columns replaced by literals."""
    out = df.withColumn(tag, F.lit("original"))
    for name, repl in variants.items():
        v = df.withColumns({c: F.lit(x).cast(dict(df.dtypes)[c]) for c, x in repl.items()})
        out = out.unionByName(v.withColumn(tag, F.lit(name)))
    return out


def accept_forecasts(runs: DataFrame, prices_df: DataFrame, key: str, order: str, run: str, value: str,
                     price: str, holdout: int) -> DataFrame:
    """ts.forecast_filter: a forecast run is rejected when any of its last
    ``holdout`` values lies below the series minimum or above twice its
    maximum.  One row per (key, run) with ``accepted``."""
    w = Window.partitionBy(key, run).orderBy(F.col(order).desc())
    held = runs.withColumn("__rb", F.row_number().over(w)).filter(F.col("__rb") <= holdout)
    rng = prices_df.groupBy(key).agg(F.min(price).alias("__lo"), F.max(price).alias("__hi"))
    ok = (F.col(value) >= F.col("__lo")) & (F.col(value) <= 2 * F.col("__hi"))
    return null_safe_join(held, rng, key).groupBy(key, run).agg(F.bool_and(ok).alias("accepted"))
