"""Spark spellings of the source dialect's scalar functions (§2.7).

Each helper is a plain Column expression (JVM-side, inside whole-stage
codegen).  The traps they cover are listed in SURVEY §1.2 / §2.7.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int64_cast(x) -> Column:
    """``CAST(x AS INT64)`` of the source dialect rounds; Spark truncates."""
    return F.round(_c(x)).cast("long")


def numeric(x) -> Column:
    """``NUMERIC``: 38 digits, 9 after the point (bare Spark NUMERIC is decimal(10,0))."""
    return _c(x).cast("decimal(38,9)")


def date3(y, m, d) -> Column:
    """3-argument ``DATE(y, m, d)``."""
    return F.make_date(_c(y).cast("int"), _c(m).cast("int"), _c(d).cast("int"))


def add_days(d, n: int) -> Column:
    """``DATE_ADD(d, INTERVAL n DAY)``; ``date_add(d, INTERVAL …)`` is a type error in Spark."""
    return F.date_add(_c(d).cast("date"), n)


def ts_diff_seconds(a, b) -> Column:
    """``TIMESTAMP_DIFF(b, a, SECOND)``: whole seconds elapsed, truncated."""
    return F.timestamp_diff("SECOND", _c(a), _c(b))


def bucketize(x, splits: Sequence[float], prefix: str = "bin_") -> Column:
    """``ML.BUCKETIZE(x, [s1, s2, …])``: lower edge inclusive, labels
    ``bin_1`` … ``bin_{len(splits)+1}``; NULL stays NULL."""
    expr = F.when(_c(x).isNull(), F.lit(None))
    for i, s in enumerate(splits):
        expr = expr.when(_c(x) < s, F.lit(f"{prefix}{i + 1}"))
    return expr.otherwise(F.lit(f"{prefix}{len(splits) + 1}"))
