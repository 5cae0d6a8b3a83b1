"""Daily summaries that can be merged: any window of days without its rows.

``store_days`` writes one row per day and key: count, sum, least and largest
value, and a KLL sketch of the values (bounded size, whatever the rows).  A
rerun of a day replaces that day only.  ``over_window`` reads the days of a
window, a partition each, and merges their rows; quantiles come from the merged
sketch with a rank error of about ``2.3 / K`` (99 %), and the other columns are
exact.  Sums are kept in DECIMAL, so an average doesn't depend on the order of
merging.  NULL values are skipped; a NULL key is a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.sources import sinks

#: Size of a sketch: some 3 * K values are kept, however many are seen.
K = 1024
DAY = "day"


def rank_error(k: int = K) -> float:
    """Normalised rank error of a quantile, in 99 of 100 cases."""
    return 2.3 / k ** 0.9


def daily(df: DataFrame, keys: Sequence[str], day: str, value: str, k: int = K) -> DataFrame:
    """One row per day and key with the mergeable summary of ``value``."""
    v = F.col(value).cast("double")
    return df.groupBy(F.to_date(day).alias(DAY), *keys).agg(
        F.count(v).alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).alias("total"), F.min(v).alias("least"), F.max(v).alias("largest"),
        F.kll_sketch_agg_double(v, k).alias("sketch"))


def store_days(df: DataFrame, keys: Sequence[str], day: str, value: str, path: str, k: int = K) -> None:
    """Write the summaries of the days in ``df``, each in place of what was stored for it."""
    sinks.write_partition(daily(df, keys, day, value, k), path, date_col=DAY, cluster_by=keys)


def over_window(spark: SparkSession, path: str, keys: Sequence[str], last, days: int, quantiles: Sequence[float] = ()) -> DataFrame:
    """Per key the summary of the ``days`` days up to and with ``last``."""
    end = F.lit(last).cast("date")
    stored = spark.read.parquet(path).filter((F.col(DAY) <= end) & (F.col(DAY) > F.date_sub(end, days)))
    out = stored.filter("n > 0").groupBy(*keys).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("largest").alias("largest"),
                                                    (F.sum("total").cast("double") / F.sum("n")).alias("mean"),
                                                    F.kll_merge_agg_double("sketch").alias("sketch"))
    return out.withColumn("quantiles", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(q)) for q in quantiles]))
                          if quantiles else F.lit(None).cast("array<double>"))
