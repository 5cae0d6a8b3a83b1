"""Relational helpers for the hand rewrites Catalyst does not do by itself.

* ``anti``: NOT EXISTS / left-join-IS-NULL written as a left anti join
  (Catalyst keeps the outer-join form otherwise).
* ``null_safe_join``: an equi-join whose NULL keys match, as groups do.
* ``rollup_labelled``: pre-aggregate on all keys, then ROLLUP the small result.
* ``union_channels``: the same query over several channels, unioned.
* ``compare_periods``: self-join of an aggregate with itself shifted by k periods.
* ``pair_extremes``: i-th best next to i-th worst.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """join.anti_null: rows of ``left`` with no match in ``right``."""
    return left.join(right, on, "left_anti")


def null_safe_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of one name in which NULL keys match each other,
    as they do in GROUP BY.  The key columns are ``left``'s."""
    on = [on] if isinstance(on, str) else list(on)
    other = right.withColumnsRenamed({c: f"__right_{c}" for c in on})
    cond = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__right_{c}`")) for c in on])
    return left.join(other, cond, how).drop(*[f"__right_{c}" for c in on])  # drop ignores what a semi or anti join lacks


def rollup_labelled(df: DataFrame, cols: Sequence[str], aggs: Mapping[str, tuple[str, str]],
                    label: Sequence[str] | None = None) -> DataFrame:
    """agg.rollup + agg.rollup_label.

    Pre-aggregates on all keys (partial aggregation, one shuffle of the
    grouped rows), then ROLLUPs the small result so the Expand of the rollup
    multiplies group rows, not fact rows.  ``aggs = {out: (fn, col)}`` with
    fn in sum/min/max/count; averages must be built from sums and counts.
    Adds ``lochierarchy`` (number of rolled-up columns) and, if ``label`` is
    given, the NULL-propagating ``concat`` label of the source dialect.
    """
    cols = list(cols)
    fns = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    pre = df.groupBy(*cols).agg(*[fns[fn](c).alias(out) for out, (fn, c) in aggs.items()])
    merge = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}
    out = pre.rollup(*cols).agg(*[merge[fn](out).alias(out) for out, (fn, _) in aggs.items()],
                                *[F.grouping(c).alias(f"__g_{c}") for c in cols])
    out = out.withColumn("lochierarchy", sum(F.col(f"__g_{c}") for c in cols).cast("int"))
    if label:
        out = out.withColumn("label", F.concat(*[F.col(c) for c in label]))
    return out.drop(*[f"__g_{c}" for c in cols])


def union_channels(channels: Mapping[str, DataFrame], build: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """join.channel_union: apply ``build`` to each channel and union by name."""
    parts = [build(name, df).withColumn("channel", F.lit(name)) for name, df in channels.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_periods(agg: DataFrame, keys: Sequence[str], period: str, values: Sequence[str],
                    offset: int = 1, suffix: str = "_next") -> DataFrame:
    """join.self_offset: each (key, period) row next to the same key's row
    ``offset`` periods later (inner: both must exist).  An equi-join on
    (key, period + offset), so it is exact for sparse periods too."""
    keys = list(keys)
    later = agg.select(*keys, (F.col(period) - offset).alias(period),
                       *[F.col(v).alias(v + suffix) for v in values])
    return agg.join(later, [*keys, period], "inner")


def pair_extremes(df: DataFrame, item: str, score: str, n: int) -> DataFrame:
    """win.best_worst: rank items ascending and descending by ``score`` and
    join equal ranks up to n.

    ``rank`` gives tied items one rank and leaves the following ranks out, so
    all items tied at a rank are paired with all items of that rank on the
    other side, and a rank that one side skips has no pair."""
    best = df.select(F.col(item).alias("best_item"), F.col(score).alias("best_score"),
                     F.rank().over(Window.orderBy(F.col(score).asc())).alias("rnk")).filter(F.col("rnk") <= n)
    worst = df.select(F.col(item).alias("worst_item"), F.col(score).alias("worst_score"),
                      F.rank().over(Window.orderBy(F.col(score).desc())).alias("rnk")).filter(F.col("rnk") <= n)
    return best.join(worst, "rnk")


def ratio(num: Column, den: Column) -> Column:
    """agg.ratio: NULL instead of a division-by-zero error (ANSI mode)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def within_band(cols: Sequence[Column], pct: float = 0.1) -> Column:
    """agg.band: every value within ±pct of every other one."""
    conds = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i != j:
                conds.append(a.between((1 - pct) * b, (1 + pct) * b))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def band_scalars(df: DataFrame, bands: Mapping[str, Column], measures: Mapping[str, Callable[[], Column]]) -> DataFrame:
    """join.cross_scalar: one row with columns ``{band}_{measure}``, in one scan.

    Each row goes once to every band whose predicate holds (bands may
    overlap; a row in no band is dropped before the grouping), the bands are
    aggregated as groups (a single distinct aggregate is planned as two hash
    aggregations, with no Expand of every row per band), and the few band
    rows become one.  A band without rows gives NULL measures (counts 0), as
    its scalar subquery would."""
    inside = F.filter(F.array(*[F.when(pred, F.lit(name)) for name, pred in bands.items()]), lambda b: b.isNotNull())
    per_band = (df.withColumn("__band", F.explode(inside))
                  .groupBy("__band").agg(*[make().alias(m) for m, make in measures.items()]))
    cells = [F.max(F.when(F.col("__band") == b, F.col(m))).alias(f"{b}_{m}") for b in bands for m in measures]
    counts = [f"{b}_{m}" for b in bands for m in measures if per_band.schema[m].dataType.typeName() == "long"]
    return per_band.agg(*cells).fillna(0, subset=counts)


def distinct_counts(df: DataFrame, by: Sequence[str], cols: Mapping[str, str], aggs: Sequence[Column] = ()) -> DataFrame:
    """agg.count_distinct with several distinct columns: one two-phase hash
    aggregate per column (each scan reads only its column), joined on the
    group key, instead of Catalyst's Expand that copies every row once per
    distinct column before aggregating.  ``cols = {out_name: column}``;
    ``aggs`` are ordinary aggregates computed alongside."""
    by = list(by)
    if not by:  # one row: each distinct count is a scalar subquery
        out = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
        return out.withColumns({name: df.select(c).where(F.col(c).isNotNull()).distinct()
                                .select(F.count(F.lit(1))).scalar()
                                for name, c in cols.items()})
    out = df.groupBy(*by).agg(*aggs) if aggs else df.select(*by).distinct()
    for name, c in cols.items():
        # NULL is not a value for COUNT(DISTINCT)
        n = (df.select(*by, c).where(F.col(c).isNotNull()).distinct()
               .groupBy(*by).agg(F.count(F.lit(1)).alias(name)))
        out = null_safe_join(out, n, by, "left")
    return out.fillna(0, subset=list(cols))
