"""src.as_of: a table as of a past time, on plain Parquet.

Plain Parquet has no ``TIMESTAMP AS OF``; a table that records a timestamp per
row version answers it with a filter plus "last version per key".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of(df: DataFrame, keys: Sequence[str], ts_col: str, at, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per key with ``ts_col <= at``.

    An aggregate (``max_by`` over a struct) rather than a window: each map
    task keeps one row per key before the shuffle, so a key with many
    versions never lands whole in one task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts_col), *[F.col(t) for t in tie])
    packed = F.struct(*[F.col(c).alias(c) for c in rest])
    live = df.filter(F.col(ts_col) <= F.lit(at).cast(dict(df.dtypes)[ts_col]))
    return (live.groupBy(*keys).agg(F.max_by(packed, order).alias("__row"))
                .select(*keys, *[F.col("__row")[c].alias(c) for c in rest]))


def newest(df: DataFrame, ts_col: str, at, minutes_back: int = 10, n: int = 100,
           tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows as of ``at − minutes_back`` (the source query's
    ``FOR SYSTEM_TIME AS OF now − 10 min … LIMIT 100``)."""
    cut = F.lit(at).cast(dict(df.dtypes)[ts_col]) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes_back))
    return (df.filter(F.col(ts_col) <= cut)
              .orderBy(F.col(ts_col).desc(), *[F.col(t).desc() for t in tie]).limit(n))
