"""clean.* and proj.sentinel_null."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """clean.dedup: one row per ``keys``; the survivor is the row with the
    smallest ``order`` tuple (default: all remaining columns), so the result
    is deterministic.

    Implemented as an aggregate (``min_by`` over a struct), not a window:
    every map task collapses its own copies before the shuffle, so a key
    with a huge number of copies never lands whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order else rest
    # A leading null flag makes NULL order values sort last (min_by skips a
    # NULL ordering value only when it is the whole struct).
    ordering = F.struct(*[x for o in order for x in (F.col(o).isNull(), F.col(o))])
    packed = F.struct(*[F.col(c).alias(c) for c in rest])
    return (df.groupBy(*keys).agg(F.min_by(packed, ordering).alias("__row"))
              .select(*keys, *[F.col("__row")[c].alias(c) for c in rest])
              .select(*df.columns))


def drop_nan(df: DataFrame, col: str) -> DataFrame:
    """clean.nan: drop rows whose value is NaN; NULL rows stay (isnan(NULL) is false)."""
    return df.filter(~F.coalesce(F.isnan(col), F.lit(False)))


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spark NaN is not NULL; convert on read so aggregates skip it."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def dropna(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """clean.dropna: drop rows with a NULL (or NaN) in any of ``cols``."""
    cols = list(cols) if cols else df.columns
    return nan_to_null(df, [c for c in cols if dict(df.dtypes)[c] in ("double", "float")]).na.drop(subset=cols)


def sentinel_to(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """proj.sentinel_null: ``{col: (sentinel, replacement[, cast])}``.

    The sentinel is compared *before* any cast (string sentinels such as
    ``"999.9"`` stay strings); ``replacement=None`` gives NULL.
    """
    out = {}
    for c, rule in rules.items():
        sentinel, repl = rule[0], rule[1]
        cast = rule[2] if len(rule) > 2 else None
        val = F.col(c).cast(cast) if cast else F.col(c)
        repl_col = F.lit(repl).cast(cast or dict(df.dtypes)[c]) if repl is not None else F.lit(None)
        out[c] = F.when(F.col(c) == F.lit(sentinel), repl_col).otherwise(val)
    return df.withColumns(out)
