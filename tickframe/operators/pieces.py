"""Ordered operators for keys of any size: range pieces, carries, halos, scans.

A window partitioned by a key puts the key's rows into one task.  Here a key
that has more than ``rows`` rows is cut into ranges of its order, each a window
partition of its own, and what a range needs from those before it comes from a
small table:

* ``pieces`` cuts by splitters taken from a hashed sample of the hot keys' order
  values; the cut is by the full order, so a hot (key, day) is cut as well;
* ``running`` and ``shifted`` add the totals or last rows of earlier pieces (the
  *carry*, one row per piece);
* ``rolling`` numbers the rows, cuts by number and gives each range a *halo*,
  the last rows of the range before;
* ``affine`` solves y = a * y_prev + b by composing blocks of the recurrence,
  level upon level, in built-in expressions.

Splitters and carries exist for hot keys only, at most ``MAX_PIECES`` rows in
all (``rows`` is raised until that holds), so they are broadcast.  NULL keys
are a key.  NULL order values come first, as in ORDER BY.  Rows that tie in the
whole order have no defined order among them, with or without pieces.  The input
is read three times (sizes, sample, rows): pass a table or a cheap projection,
not a long plan.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.session import scratch_path

#: Rows of a key from which it is cut, and about the rows of a piece.
PIECE_ROWS = 1 << 14
#: Pieces of all hot keys together, at most about.
MAX_PIECES = 1 << 15
#: Sampled rows of a piece.
SAMPLE = 32
KEY, PIECE, ROW = "__key", "__piece", "__row"


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{o}`").alias(f"o{k}") for k, o in enumerate(order)])


def keyed(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``df`` with its key as one struct: never NULL, so it joins and groups alike."""
    return df.withColumn(KEY, F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(_cols(keys))]) if keys else F.struct(F.lit(0).alias("k0")))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def splitters(df: DataFrame, order: Sequence[str], rows: int) -> tuple[DataFrame, int] | None:
    """(KEY, cuts) for each key of a keyed table with more than ``rows`` rows: its splitters in
    order; and the most splitters of a key.  None if there is no such key."""
    sizes = _stored(df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows), "hot")
    total = sizes.agg(F.sum("n")).first()[0]
    if not total:
        return None
    rows = max(rows, -(-total // MAX_PIECES))
    hot = sizes.filter(F.col("n") > rows).select(KEY)  # at most total / rows keys
    every = max(1, rows // SAMPLE)
    sample = df.select(KEY, _order(order).alias("o")).join(F.broadcast(hot), KEY)
    sample = sample.filter(F.pmod(F.xxhash64(KEY, "o"), F.lit(every)) == 0)
    sample = sample.withColumn("r", F.row_number().over(Window.partitionBy(KEY).orderBy("o")))
    cuts = sample.filter(F.col("r") % min(SAMPLE, rows) == 0).groupBy(KEY).agg(F.array_sort(F.collect_set("o")).alias("cuts"))
    cuts = _stored(cuts, "splitters")
    return cuts, cuts.agg(F.max(F.size("cuts"))).first()[0] or 0


def pieces(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], rows: int = PIECE_ROWS) -> tuple[DataFrame, bool]:
    """``df`` with KEY and PIECE, the number of its range within the key, and whether any key was cut."""
    df, order = keyed(df, keys), _cols(order)
    found = splitters(df, order, rows)
    if found is None:
        return df.withColumn(PIECE, F.lit(0)), False
    cuts, most = found
    df = df.withColumn("__o", _order(order)).join(F.broadcast(cuts.withColumnRenamed("cuts", "__cuts")), KEY, "left").withColumn(PIECE, F.lit(0))
    # halving, a projection a step: higher-order functions are not compiled, so that each row would get a copy of all its key's splitters
    for step in (1 << k for k in reversed(range(most.bit_length()))):
        ahead = F.col(PIECE) + step
        df = df.withColumn(PIECE, F.when(F.get("__cuts", ahead - 1) <= F.col("__o"), ahead).otherwise(F.col(PIECE)))
    # the optimizer follows a join's key down through projections, and each step names the one before three times; it stops at a generated column
    df = df.withColumn(PIECE, F.explode(F.array(PIECE)))
    return df.drop("__o", "__cuts"), True


def _within(order: Sequence[str], *key: str, descending: bool = False):
    cols = [F.col(f"`{o}`") for o in order]
    return Window.partitionBy(*key).orderBy(*[c.desc() if descending else c for c in cols])


def _carry(d: DataFrame, whole: Column, before, descending: bool = False) -> DataFrame:
    """(KEY, PIECE, carry): ``before`` of the pieces' ``whole`` over the pieces ahead; only pieces that
    have some ahead, so none of a key that was not cut."""
    each = d.groupBy(KEY, PIECE).agg(whole.alias("__whole"))
    w = _within([PIECE], KEY, descending=descending)
    each = each.withColumn("__carry", before(F.col("__whole")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    each = each.withColumn("__rank", F.row_number().over(w)).filter("__rank > 1")
    return F.broadcast(each.select(KEY, PIECE, "__carry"))


def running(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], value: str, fn: str = "sum",
            out: str | None = None, rows: int = PIECE_ROWS, descending: bool = False) -> DataFrame:
    """Running ``sum``, ``count``, ``max``, ``min`` or ``last`` (non-null: forward fill) of ``value``
    per key in the order given, or in the opposite one.  NULL values are skipped, as in SQL."""
    order, out = _cols(order), out or f"running_{fn}"
    d, cut = pieces(df, keys, order, rows)
    w = _within(order, KEY, PIECE, descending=descending).rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(f"`{value}`")
    if fn == "last":
        boxed = F.when(v.isNotNull(), F.struct(v.alias("v")))
        inner = F.last(boxed, ignorenulls=True).over(w)
        whole = (F.min_by if descending else F.max_by)(boxed, F.when(v.isNotNull(), _order(order)))

        def before(x: Column) -> Column:
            return F.last(x, ignorenulls=True)
        both = F.coalesce(F.col("__in"), F.col("__carry"))["v"]
    else:
        agg = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[fn]
        inner, whole = agg(v).over(w), agg(v)
        before = F.sum if fn == "count" else agg
        join = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "max": F.greatest, "min": F.least}[fn]
        a, b = F.col("__in"), F.col("__carry")
        both = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(join(a, b))
    if not cut:
        return d.withColumn(out, inner["v"] if fn == "last" else inner).drop(KEY, PIECE)
    d2 = d.withColumn("__in", inner).join(_carry(d, whole, before, descending), [KEY, PIECE], "left")
    kind = d2.schema["__in"].dataType
    return d2.withColumn(out, both if fn == "last" else both.cast(kind)).drop(KEY, PIECE, "__in", "__carry")


def numbered(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], out: str = ROW, rows: int = PIECE_ROWS) -> DataFrame:
    """``df`` with each row's number within its key, from 1."""
    one = "__one"
    return running(df.withColumn(one, F.lit(1)), keys, order, one, "count", out, rows).drop(one)


def shifted(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], values: Sequence[str], prefix: str = "prev_",
            rows: int = PIECE_ROWS) -> DataFrame:
    """``lag(values)`` per key in the order given."""
    order, values = _cols(order), list(values)
    d, cut = pieces(df, keys, order, rows)
    packed = F.struct(*[F.col(f"`{v}`").alias(v) for v in values])
    d2 = d.withColumn("__prev", F.lag(packed).over(_within(order, KEY, PIECE)))
    if cut:
        d2 = d2.join(_carry(d, F.max_by(packed, _order(order)), lambda x: F.last(x)), [KEY, PIECE], "left")
        d2 = d2.withColumn("__prev", F.coalesce("__prev", "__carry")).drop("__carry")
    return d2.select("*", *[F.col("__prev")[v].alias(prefix + v) for v in values]).drop("__prev", KEY, PIECE)


ROLLING = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def rolling(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], value: str, fn: str, window: int,
            min_periods: int | None = None, shift: int = 0, out: str | None = None, rows: int = PIECE_ROWS) -> DataFrame:
    """``fn`` of the ``window`` rows that end ``shift`` rows before each row; NULL with fewer than
    ``min_periods`` (default: ``window``) non-null values among them."""
    min_periods = window if min_periods is None else min_periods
    reach, out = window - 1 + shift, out or f"{fn}_{window}"
    d = keyed(numbered(df, keys, order, rows=rows), keys)
    length = max(rows, reach + 1)
    own = F.floor((F.col(ROW) - 1) / length)
    # the last rows of a range also go to the next one
    late = F.pmod(F.col(ROW) - 1, F.lit(length)) >= length - reach
    d = d.withColumn("__own", own).withColumn(PIECE, F.explode(F.when(late, F.array("__own", F.col("__own") + 1)).otherwise(F.array("__own"))))
    w = Window.partitionBy(KEY, PIECE).orderBy(ROW).rowsBetween(-reach, -shift)
    d = d.withColumn(out, F.when(F.count(f"`{value}`").over(w) >= min_periods, ROLLING[fn](f"`{value}`").over(w)))
    return d.filter(F.col("__own") == F.col(PIECE)).drop("__own", KEY, PIECE, ROW)


# ---------------------------------------------------------------- affine recurrences

#: Rows of a block, and the smallest weight within one.
BLOCK, TINY = 1024, 1e-120


def _levels(d: DataFrame, a: float, depth: int = 0) -> DataFrame:
    """(KEY, n, y) of the recurrence over rows (KEY, n, b) numbered from 0 without gaps."""
    if a == 0:
        return d.withColumnRenamed("b", "y")
    all_before = Window.partitionBy(KEY).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    if a == 1 and depth >= 2:  # a running sum over the ends of 1024 * 1024 rows each
        return d.withColumn("y", F.sum("b").over(all_before)).drop("b")
    size = BLOCK if abs(a) ** BLOCK > TINY else max(1, int(math.log(TINY) / math.log(abs(a))))
    if size == 1:
        # the weight is so small that it vanishes a few rows back; only a NaN stays for good
        y, w = F.col("b"), Window.partitionBy(KEY).orderBy("n")
        for k in range(1, math.ceil(math.log(1e-300) / math.log(abs(a))) + 1):
            y = y + F.coalesce(F.lag("b", k).over(w), F.lit(0.0)) * (a ** k)
        bad = F.max(F.isnan("b")).over(all_before)
        return d.withColumn("y", F.when(bad, F.lit(float("nan"))).otherwise(y)).drop("b")
    d = d.withColumn("k", F.floor(F.col("n") / size)).withColumn("j", F.col("n") % size)
    w = Window.partitionBy(KEY, "k").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("part", F.sum(F.col("b") * F.pow(F.lit(a), -F.col("j"))).over(w) * F.pow(F.lit(a), F.col("j")))
    # the last row of a full block carries it: Y_k = a ** size * Y_(k-1) + part
    ends = d.filter(F.col("j") == size - 1).select(F.col(KEY).alias("of"), F.col("k").alias("n"), F.col("part").alias("b"))
    ahead = _levels(ends.withColumnRenamed("of", KEY), a ** size, depth + 1)
    ahead = ahead.select(F.col(KEY).alias("of"), (F.col("n") + 1).alias("at"), F.col("y").alias("from"))
    d = d.join(ahead, (F.col(KEY) == F.col("of")) & (F.col("k") == F.col("at")), "left")
    return d.select(KEY, "n", (F.col("part") + F.coalesce(F.col("from") * F.pow(F.lit(a), F.col("j") + 1), F.lit(0.0))).alias("y"))


def affine(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], a: float, b: Column, first: Column | None = None,
           out: str = "y", rows: int | None = PIECE_ROWS, descending: bool = False) -> DataFrame:
    """``y = a * y_prev + b`` per key in the order given (or in the opposite one), starting with ``first``
    (default: ``b``).

    Only built-in expressions: within a block of rows the recurrence is a
    prefix sum of ``b`` weighted by powers of ``a``; the blocks' last values
    follow the same recurrence with ``a ** block``, solved the same way.

    Rows whose ``b`` is NULL have NULL and are passed over: the next row goes on
    from the last value.  From a NaN or infinite ``b`` on, all rows of its key
    are NaN.  With ``rows=None`` the series are known to be short and are
    numbered by a plain window.
    """
    if not abs(a) <= 1:
        raise ValueError("the weight must lie between -1 and 1")
    order, live = _cols(order), "__live"
    d = df.withColumn("__b", b.cast("double")).withColumn("__first", (b if first is None else first).cast("double"))
    d = d.withColumn(live, F.when(F.col("__b").isNotNull(), F.lit(1)))
    if rows is None:
        w = _within(order, KEY, descending=descending).rowsBetween(Window.unboundedPreceding, 0)
        d = keyed(d, keys).withColumn(ROW, F.count(live).over(w))
    else:
        d = keyed(running(d, keys, order, live, "count", ROW, rows, descending), keys)
    x = F.when(F.col(ROW) == 1, F.col("__first")).otherwise(F.col("__b"))
    x = F.when(F.abs(x) < float("inf"), x).otherwise(F.lit(float("nan")))
    d = d.withColumn("__n", F.when(F.col(live) == 1, F.col(ROW) - 1)).withColumn("__b", x).drop(live, ROW, "__first")
    y = _levels(d.filter("__n IS NOT NULL").select(F.col(KEY).alias("of"), F.col("__n").alias("n"), F.col("__b").alias("b")).withColumnRenamed("of", KEY),
                float(a))
    y = y.select(F.col(KEY).alias("of"), F.col("n").alias("at"), F.col("y").alias("__y"))
    d = d.join(y, (F.col(KEY) == F.col("of")) & (F.col("__n") == F.col("at")), "left")
    return d.withColumn(out, F.col("__y")).drop(KEY, "of", "at", "__n", "__b", "__y")


# ---------------------------------------------------------------- point in time

def as_of_many(versions: DataFrame, questions: DataFrame, keys: str | Sequence[str], ts_col: str, at_col: str,
               tie: Sequence[str] = (), prefix: str = "", rows: int = PIECE_ROWS) -> DataFrame:
    """For each row of ``questions`` the newest version of its key with ``ts_col <= at_col``.

    Versions and questions go through one pass: united, ordered by time (a
    version before a question of the same time), and the last version carried
    forward.  The versions' other columns are added with ``prefix``; they are
    NULL where no version is old enough.  Rows with a NULL time are no version.
    """
    keys, tie = _cols(keys), list(tie)
    rest = [c for c in versions.columns if c not in keys]
    kind = versions.schema[ts_col].dataType
    v = versions.filter(F.col(f"`{ts_col}`").isNotNull()).select(
        *[F.col(f"`{k}`") for k in keys], F.col(f"`{ts_col}`").alias("__at"), F.lit(0).alias("__tag"),
        *[F.col(f"`{t}`").alias(f"__t{i}") for i, t in enumerate(tie)], F.struct(*[F.col(f"`{c}`").alias(c) for c in rest]).alias("__version"))
    q = questions.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{at_col}`").cast(kind).alias("__at"), F.lit(1).alias("__tag"),
                         F.struct(*[F.col(f"`{c}`").alias(c) for c in questions.columns]).alias("__question"))
    both = v.unionByName(q, allowMissingColumns=True)
    both = running(both, keys, ["__at", "__tag", *[f"__t{i}" for i in range(len(tie))]], "__version", "last", "__last", rows)
    both = both.filter("__tag = 1")
    return both.select("__question.*", *[F.when(F.col("__at").isNotNull(), F.col("__last")[c]).alias(prefix + c) for c in rest])
