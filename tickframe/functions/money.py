"""Exact money arithmetic.

Prices and rates in the data carry two decimals.  Summing them as DOUBLE
gives results that depend on the summation order (partition layout), so
sums are taken in DECIMAL and converted once at the end; an average is that
exact sum divided by the count.  The result is then independent of how the
data is partitioned, which matters for reproducible reports at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def dec(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def dsum(c) -> Column:
    """Exact sum of a 2-decimal quantity (or a product of them), as DOUBLE."""
    return F.sum(c if isinstance(c, Column) and not isinstance(c, str) else dec(c)).cast("double")


def davg(c) -> Column:
    """Average as exact sum / number of non-null values."""
    x = c if isinstance(c, Column) else dec(c)
    return F.sum(x).cast("double") / F.count(x)


def net(price="l_extendedprice", disc="l_discount") -> Column:
    """price · (1 − discount), exact."""
    return dec(price) * (1 - dec(disc))


# SQL spellings of the same expressions for the DuckDB oracles
def D(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


def DSUM(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE)"


def DAVG(expr: str) -> str:
    return f"(CAST(sum({expr}) AS DOUBLE) / count({expr}))"


NET = f"({D('l_extendedprice')} * (1 - {D('l_discount')}))"
