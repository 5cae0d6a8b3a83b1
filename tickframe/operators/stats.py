"""Statistics operators: describe, histogram, correlation matrix, VaR.

Everything is a grouped aggregate (partial aggregation before the shuffle)
or a join of small aggregate tables; nothing collects a group's rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.operators.relational import null_safe_join
from tickframe.session import scratch_path

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """agg.summary (pandas ``describe``): count, mean, std, min, 25 %, 50 %,
    75 %, max per column, long form (one row per column).  Moments come from
    one aggregate pass over all columns; the exact quartiles from one
    skew-safe ``exact_percentiles`` pass over the unpivoted (column, value)
    rows, so no group's values are gathered into one task."""
    from tickframe.operators.quantiles import exact_percentiles
    by = list(by)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                             F.max(x).alias("max")).alias(f"__s{i}"))
    one = df.groupBy(*by).agg(*aggs)
    moments = one.select(*by, F.explode(F.array(*[F.col(f"__s{i}") for i in range(len(cols))])).alias("s")) \
                 .select(*by, "s.*")
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(*[f"`{b}`" for b in by], f"stack({len(cols)}, {stack}) AS (column, __x)")
    q = exact_percentiles(long, [*by, "column"], "__x", list(QUARTILES))
    wide = q.groupBy(*by, "column").pivot("q", list(QUARTILES)).agg(F.first("__x"))
    wide = wide.select(*by, "column", *[F.col(f"`{wide.columns[len(by) + 1 + i]}`").alias(n)
                                        for i, n in enumerate(("q25", "q50", "q75"))])
    out = null_safe_join(moments, wide, [*by, "column"], "left")
    return out.select(*by, "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """agg.histogram: equal-width bins between the group's min and max, the
    last edge closed (numpy ``histogram``).  One small (min, max) aggregate
    joined back, then a grouped count: no row leaves its partition before
    the partial count."""
    by = list(by)
    if by:
        rng = df.groupBy(*by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
        j = null_safe_join(df, rng, by)  # one row per group; AQE broadcasts it when small
    else:
        j = df.withColumns({"__lo": df.select(F.min(value)).scalar(), "__hi": df.select(F.max(value)).scalar()})
    width = (F.col("__hi") - F.col("__lo")) / bins
    idx = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("__lo")) / width), F.lit(bins - 1)))
    j = j.filter(F.col(value).isNotNull()).withColumn("bin", idx.cast("int"))
    return (j.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"),
                                      F.first("__lo").alias("lo"), F.first("__hi").alias("hi"))
             .withColumn("edge_lo", F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins)
             .drop("lo", "hi"))


#: Keys of a block and dates of a block in the correlation matrix.
KEY_BLOCK, DATE_BLOCK = 256, 2048


def corr_matrix(df: DataFrame, key: str, date: str, value: str, key_block: int = KEY_BLOCK, date_block: int = DATE_BLOCK) -> DataFrame:
    """agg.corr_matrix: Pearson correlation of ``value`` between every pair of
    keys (a ≤ b), each pair over the dates where both exist (non-NULL).

    A blocked Gram product: keys and dates are dealt into blocks by hash, a
    task takes two blocks of keys and one of dates as matrices (values, less
    each key's mean, and a mask of the days that exist) and emits six partial
    sums per pair of keys; these are added up over the blocks of dates.  No
    row is paired with another row, and what is shuffled per block of dates is
    one row per pair of keys, as in the result.  NULL keys and dates take no
    part; of several rows of a key and date the largest value counts.  A pair
    with fewer than two common dates or without variance has NULL, a pair that
    meets a NaN or an infinite value NaN.
    """
    import numpy as np
    import pandas as pd

    s = df.select(F.col(key).alias("a"), F.col(date).alias("d"), F.col(value).cast("double").alias("x"))
    s = s.filter("a IS NOT NULL AND d IS NOT NULL AND x IS NOT NULL")
    s = s.groupBy("a", "d").agg(F.max("x").alias("x"))
    finite = F.when(F.abs("x") < float("inf"), F.col("x"))
    mean = s.groupBy("a").agg(F.coalesce(F.avg(finite), F.lit(0.0)).alias("m"))
    n_keys, n_dates = s.select(F.count_distinct("a"), F.count_distinct("d")).first()
    blocks, spans = -(-n_keys // key_block) or 1, -(-n_dates // date_block) or 1
    s = s.join(mean, "a").withColumn("x", F.col("x") - F.col("m")).drop("m")
    s = s.withColumn("k", F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int")).withColumn("t", F.pmod(F.xxhash64("d"), F.lit(spans)).cast("int"))
    s = s.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    s = s.withColumn("i", F.least("k", "o")).withColumn("j", F.greatest("k", "o")).drop("o")
    kind = df.schema[key].dataType.simpleString()

    def gram(p: pd.DataFrame) -> pd.DataFrame:
        i, j = p["i"].iloc[0], p["j"].iloc[0]
        days, col = np.unique(p["d"].to_numpy(), return_inverse=True)

        def side(k):
            names, row = np.unique(p["a"].to_numpy()[p["k"] == k], return_inverse=True)
            x, mask = np.zeros((len(names), len(days))), np.zeros((len(names), len(days)))
            at = (row, col[(p["k"] == k).to_numpy()])
            v = p["x"].to_numpy()[p["k"] == k]
            bad = ~np.isfinite(v)
            x[at], mask[at] = np.where(bad, 0.0, v), 1.0
            wild = np.zeros_like(mask)
            wild[at] = bad
            return names, x, mask, wild
        an, ax, am, aw = side(i)
        bn, bx, bm, bw = (an, ax, am, aw) if i == j else side(j)
        sums = {"n": am @ bm.T, "sx": ax @ bm.T, "sy": am @ bx.T, "sxx": (ax * ax) @ bm.T, "syy": am @ (bx * bx).T, "sxy": ax @ bx.T,
                "wild": aw @ bm.T + am @ bw.T}
        r, c = np.nonzero(sums["n"])
        if i == j:
            r, c = r[an[r] <= bn[c]], c[an[r] <= bn[c]]
        out = pd.DataFrame({"a": an[r], "b": bn[c], **{k: v[r, c] for k, v in sums.items()}})
        swap = (out["a"] > out["b"]).to_numpy()
        for x, y in (("a", "b"), ("sx", "sy"), ("sxx", "syy")):
            first, second = out[x].to_numpy(), out[y].to_numpy()
            out[x], out[y] = np.where(swap, second, first), np.where(swap, first, second)
        return out

    parts = s.groupBy("i", "j", "t").applyInPandas(
        gram, f"a {kind}, b {kind}, n double, sx double, sy double, sxx double, syy double, sxy double, wild double")
    total = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy", "wild")])
    vx, vy = (F.col(f"s{v}{v}") - F.col(f"s{v}") * F.col(f"s{v}") / F.col("n") for v in "xy")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    # what rounding leaves of a variance of zero is no variance
    some = (F.col("n") > 1) & (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    corr = F.when(F.col("wild") > 0, F.lit(float("nan"))).when(some, cov / F.sqrt(vx * vy))
    return total.select("a", "b", corr.alias("corr"))


# ---------------------------------------------------------------- co-moments

STATE = ("n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy")


def comoments(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Per group the co-moment state of the rows where both are non-NULL: count, means, sums of
    squared deviations and of their product.  One partial aggregate; states of parts can be
    merged (``merge_comoments``) without the rows."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    u, v = (F.when(both, F.col(c).cast("double")) for c in (x, y))
    n = F.count(u)
    return df.groupBy(*by).agg(n.alias("n"), F.avg(u).alias("mean_x"), F.avg(v).alias("mean_y"), (F.var_pop(u) * n).alias("m2_x"),
                               (F.var_pop(v) * n).alias("m2_y"), (F.covar_pop(u, v) * n).alias("c_xy"))


def merge_comoments(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of coarser groups from the states of their parts: the parts' own deviations
    plus those of their means from the common mean."""
    by, states = list(by), states.filter("n > 0")
    if not by:
        # one group, by a key that is not a literal: joining on a literal would be a product
        return merge_comoments(states.withColumn("__all", F.col("n") * 0), ["__all"]).drop("__all")
    means = states.groupBy(*by).agg(F.sum("n").alias("__n"), (F.sum(F.col("n") * F.col("mean_x")) / F.sum("n")).alias("__x"),
                                    (F.sum(F.col("n") * F.col("mean_y")) / F.sum("n")).alias("__y"))
    j = null_safe_join(states, means, by)
    dx, dy = F.col("mean_x") - F.col("__x"), F.col("mean_y") - F.col("__y")
    return j.groupBy(*by).agg(F.sum("n").alias("n"), F.first("__x").alias("mean_x"), F.first("__y").alias("mean_y"),
                              F.sum(F.col("m2_x") + F.col("n") * dx * dx).alias("m2_x"), F.sum(F.col("m2_y") + F.col("n") * dy * dy).alias("m2_y"),
                              F.sum(F.col("c_xy") + F.col("n") * dx * dy).alias("c_xy"))


def corr_of(prefix: str = "") -> Column:
    """Pearson correlation of a co-moment state; NULL without variance."""
    x, y = F.col(f"{prefix}m2_x"), F.col(f"{prefix}m2_y")
    return F.when((x > 0) & (y > 0), F.col(f"{prefix}c_xy") / F.sqrt(x * y))


def corr_points(calls: DataFrame, weather: DataFrame, label: str, day: str, measure: str) -> DataFrame:
    """The points of a correlation report: per label and value of ``measure`` the average daily
    count and share of the label's rows over the days with that value.

    ``calls`` has a row per call (label, day), ``weather`` rows with (day, measure), possibly several
    per day, each of which counts, and a day's share is its calls over its weather rows.  Both
    sides are counted per day before they meet, so no row is joined with a row."""
    per_day = calls.groupBy(day, label).agg(F.count(F.lit(1)).alias("day_count"))
    w = weather.groupBy(day, measure).agg(F.count(F.lit(1)).alias("times"))
    w = w.join(w.groupBy(day).agg(F.sum("times").alias("all_count")), day)
    j = per_day.join(w, day)
    times, n = F.col("times"), F.col("day_count")
    return j.groupBy(label, measure).agg(
        (F.sum(times * n / F.col("all_count")) / F.sum(times)).alias("avg_share"),
        (F.sum(times * n) / F.sum(times)).alias("avg_count"), F.sum(times * n).alias("total"))


def corr_report(points: DataFrame, label: str, measure: str, min_total: int = 5000, min_corr: float = 0.5, min_points: int = 5) -> DataFrame:
    """agg.corr: labels with more than ``min_total`` calls and ``min_points`` points whose average
    share correlates with the measure by more than ``min_corr`` either way, strongest first."""
    totals = points.groupBy(label).agg(F.sum("total").alias("total_count"), F.count(measure).alias("data_count"))
    by_count = comoments(points, [label], measure, "avg_count").select(label, F.round(corr_of(), 3).alias("corr_count"))
    by_share = comoments(points, [label], measure, "avg_share").select(label, F.round(corr_of(), 3).alias("corr_share"))
    out = null_safe_join(null_safe_join(totals, by_count, label), by_share, label)
    keep = (F.col("total_count") > min_total) & (F.abs("corr_share") > min_corr) & (F.col("data_count") > min_points)
    return out.filter(keep).orderBy(F.abs("corr_share").desc(), label)


def var_hist(returns: DataFrame, key: str, ret: str, q: float = 0.05) -> DataFrame:
    """ts.var_bootstrap: historical value-at-risk = the q-quantile of returns
    (exact, linear interpolation, skew-safe: see ``quantiles``)."""
    from tickframe.operators.quantiles import exact_percentiles
    n = returns.groupBy(key).agg(F.count(ret).alias("n_returns"))
    v = exact_percentiles(returns, [key], ret, [q]).select(key, F.col(ret).alias("var_quantile"))
    return n.join(v, key, "left")


def hashed_normal(*counter: Column) -> Column:
    """A standard normal from a hash of its counter: two 52-bit uniforms from one MD5, by Box-Muller.

    It depends on the counter alone, not on partitions, order or retries, and any engine
    with MD5 can restate it."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in counter]))

    def unit(at: int) -> Column:
        return (F.conv(F.substring(digest, at, 13), 16, 10).cast("double") + 1) / F.lit(2.0 ** 52)
    return F.sqrt(-2 * F.log(unit(1))) * F.cos(2 * math.pi * unit(14))


def var_mc(stats: DataFrame, key: str, start: str, mu: str, sigma: str, days: int = 365,
           runs: int = 10000, seed: int = 42, q: float = 0.01) -> DataFrame:
    """ts.var_montecarlo: per key and run, ``days − 1`` steps of
    ``p += p·(μ·dt + N(μ·dt, σ·√dt))`` with dt = 1/days (the drift is counted
    twice, as in the source notebook), then mean final price, q-quantile and
    VaR = start − quantile.

    Runs and steps are rows generated from each key's statistics row; the
    steps of one run are a ``product`` aggregate, so the work is spread over
    all runs in parallel.  The draw of (seed, key, run, step) is a hash of
    these, so the result is the same however the runs are dealt; the quantile
    is exact (linear interpolation).
    """
    from tickframe.operators.quantiles import exact_percentiles
    dt = 1.0 / days
    # runs and steps are generated per key row (no join): key → runs → steps
    per_run = stats.select(key, start, F.col(mu).alias("__mu"), F.col(sigma).alias("__sd"),
                           F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    # spread the runs of each key over tasks before generating their steps
    per_run = per_run.repartition(key, "run")
    walk = per_run.select("*", F.explode(F.sequence(F.lit(1), F.lit(days - 1))).alias("step"))
    z = hashed_normal(F.lit(seed), F.col(key), F.col("run"), F.col("step"))
    growth = 1 + 2 * F.col("__mu") * dt + F.col("__sd") * (dt ** 0.5) * z
    # grouped by exactly the repartition keys: no second shuffle of the steps
    final = walk.groupBy(key, "run").agg((F.first(start) * F.product(growth)).alias("final_price"))
    path = scratch_path(stats.sparkSession, f"var-{uuid.uuid4().hex}")
    final.write.parquet(path)  # the runs' ends, read for the mean and the quantile
    final = stats.sparkSession.read.parquet(path)
    low = exact_percentiles(final, [key], "final_price", [q]).select(key, F.col("final_price").alias("q_final"))
    out = null_safe_join(final.groupBy(key).agg(F.avg("final_price").alias("mean_final")), low, key)
    out = null_safe_join(stats.select(key, start), out, key)
    return out.withColumn("var", F.col(start) - F.col("q_final"))
