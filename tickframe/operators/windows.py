"""Window operators (win.*): lag/change, idle gaps, rolling frames, lag vectors.

All functions take the key, order and value columns as arguments and handle
every key in one plan.  Two families:

* series-level (bars, one row per key and day): per-key row counts are bounded
  by the calendar, so a plain ``partitionBy(key)`` window is the right plan;
* row-level (raw events): a key may hold a large share of all rows, so
  ``lag_split``, and ``running`` and ``rolling`` with ``split``, cut hot keys
  into ranges of their order (see ``pieces``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators import pieces
from tickframe.operators.relational import null_safe_join


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def lag_change(df: DataFrame, key="Name", order="Date", value="Close", digits: int = 2,
               prev_col="prev_close", change_col="change", pct_col="change_in_percent") -> DataFrame:
    """win.lag + win.change: previous value, rounded change (0 on the first row)
    and percentage computed from the *rounded* change (NULL on the first row).

    Division uses ``try_divide`` so a zero previous price yields NULL, as a
    non-ANSI engine would, instead of failing the job.
    """
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    prev = F.lag(value).over(w)
    out = df.withColumn(prev_col, prev)
    diff = F.col(value) - F.col(prev_col)
    out = out.withColumn(change_col, F.when(diff.isNull(), F.lit(0.0)).otherwise(F.round(diff, digits)))
    return out.withColumn(
        pct_col, F.round(F.try_divide(F.col(change_col), F.col(prev_col)) * 100, digits))


def lag_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
              bucket: Column | None = None, prefix: str = "prev_", rows: int = pieces.PIECE_ROWS) -> DataFrame:
    """Exact ``lag(values)`` per key ordered by ``order``, skew-safe.

    Keys with more than ``rows`` rows are cut into ranges by sampled splitters
    of the full order.  A caller who knows a ``bucket`` that is monotone in
    ``order`` and small for every key (say, the hour) may give it instead: rows
    are then windowed per (key, bucket), and the first row of each bucket takes
    the last row of the previous non-empty one from a per-(key, bucket) tail
    table that is partially aggregated before the shuffle.
    """
    keys, order, values = list(keys), list(order), list(values)
    if bucket is None:
        return pieces.shifted(df, keys, order, values, prefix, rows)
    b = "__bucket"
    d = df.withColumn(b, bucket)
    w_in = Window.partitionBy(*keys, b).orderBy(*order)
    packed = F.struct(*[F.col(v).alias(v) for v in values])
    d = d.withColumn("__prev_in", F.lag(packed).over(w_in))
    tails = (d.groupBy(*keys, b)
             .agg(F.max_by(packed, F.struct(*[F.col(o) for o in order])).alias("__tail")))
    w_b = Window.partitionBy(*keys).orderBy(b)
    edges = tails.select(*keys, b, F.lag("__tail").over(w_b).alias("__prev_tail"))
    j = null_safe_join(d, edges, [*keys, b], "left")
    prev = F.coalesce(F.col("__prev_in"), F.col("__prev_tail"))
    j = j.select("*", *[prev[v].alias(prefix + v) for v in values])
    return j.drop("__prev_in", "__prev_tail", b)


def idle_gap(df: DataFrame, key: str, start: str, end: str, order_tie: str, rows: int = pieces.PIECE_ROWS) -> DataFrame:
    """win.gap: seconds between this row's start and the previous row's end
    per key (NULL on a key's first row)."""
    out = lag_split(df, [key], [start, order_tie], [end], prefix="__p_", rows=rows)
    return out.withColumn(
        "gap_seconds", F.timestamp_diff("SECOND", F.col("__p_" + end), F.col(start))).drop("__p_" + end)


def rolling(df: DataFrame, key, order, value: str, fn: str, window: int,
            min_periods: int | None = None, shift: int = 0, out: str | None = None, split: int | None = None) -> DataFrame:
    """win.rolling_mean / rolling_std / rolling_extreme (pandas ``rolling``).

    Frame = the ``window`` rows ending ``shift`` rows before the current one.
    The result is NULL unless at least ``min_periods`` non-null values are in
    the frame (pandas default: ``min_periods = window``).  With ``split``, keys
    of more rows than that are cut into ranges, each with the rows it needs of
    the range before.
    """
    if split is not None:
        return pieces.rolling(df, key, order, value, fn, window, min_periods, shift, out, split)
    min_periods = window if min_periods is None else min_periods
    w = (Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
         .rowsBetween(-(window - 1) - shift, -shift))
    out = out or f"{fn}_{window}"
    return df.withColumn(
        out, F.when(F.count(value).over(w) >= min_periods, pieces.ROLLING[fn](value).over(w)))


def pct_change(df: DataFrame, key, order, value: str, out: str = "pct_change") -> DataFrame:
    """win.pct_change: x / prev - 1 with earlier gaps padded forward (pandas
    ``pct_change`` default)."""
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    filled = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = df.withColumn("__ff", filled)
    return d.withColumn(out, F.try_divide(F.col("__ff"), F.lag("__ff").over(w)) - 1).drop("__ff")


def diff(df: DataFrame, key, order, value: str, out: str = "diff") -> DataFrame:
    """win.diff: x - prev."""
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    return df.withColumn(out, F.col(value) - F.lag(value).over(w))


def running(df: DataFrame, key, order, value: str, fn: str = "sum", out: str | None = None, split: int | None = None) -> DataFrame:
    """win.running_sum / win.running_max: rows unbounded preceding..current.  With ``split``, keys of
    more rows than that are cut into ranges that take up where the ranges before end."""
    if split is not None:
        return pieces.running(df, key, order, value, fn, out, split)
    w = (Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    agg = {"sum": F.sum, "max": F.max, "min": F.min}[fn]
    return df.withColumn(out or f"running_{fn}", agg(value).over(w))


def lag_features(df: DataFrame, key, order, value: str, n: int, out: str = "state") -> DataFrame:
    """win.lag_features: the last ``n`` one-step differences as an array,
    left-padded with the first value (so the padding contributes zeros)."""
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    first = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # p_k = value k rows back, padded with the series' first value
    p = [F.col(value)] + [F.coalesce(F.lag(value, k).over(w), first) for k in range(1, n + 1)]
    diffs = [p[k - 1] - p[k] for k in range(n, 0, -1)]
    return df.withColumn(out, F.array(*diffs))


def split_last(df: DataFrame, key, order, n: int, flag: str = "is_holdout") -> DataFrame:
    """win.split_last: flag the last ``n`` rows of each series."""
    w = Window.partitionBy(*_cols(key)).orderBy(*[F.col(c).desc() for c in _cols(order)])
    return df.withColumn(flag, F.row_number().over(w) <= n)


def with_neighbours(df: DataFrame, keys, order, value: str) -> DataFrame:
    """win.neighbours: previous and next value in the same partition; edge rows
    (no previous or no next) are dropped, as the rank±1 self-join does."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    boxed = F.struct(F.col(value).alias("v"))  # non-null even when the value is NULL
    return (df.withColumn("__p", F.lag(boxed).over(w))
              .withColumn("__n", F.lead(boxed).over(w))
              .filter(F.col("__p").isNotNull() & F.col("__n").isNotNull())
              .withColumn("psum", F.col("__p.v")).withColumn("nsum", F.col("__n.v"))
              .drop("__p", "__n"))
