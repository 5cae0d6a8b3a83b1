"""Ordered operators on cut keys equal the plain windows; hot keys are spread."""

import math
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import pieces, strategy
from tickframe.operators import timeseries as ts

SCHEMA = "k string, day int, n int, x double, d decimal(12,2)"


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds most rows, one of its days a third of all; a NULL key; NULLs in between."""
    rng = random.Random(7)
    data = []
    for n in range(4000):
        u = rng.random()
        k = "hot" if u < 0.7 else None if u < 0.8 else f"k{rng.randrange(40)}"
        day = 5 if k == "hot" and rng.random() < 0.5 else rng.randrange(-10, 10)
        x = None if rng.random() < 0.1 else round(rng.uniform(-50, 50), 3)
        data.append((k, None if rng.random() < 0.002 else day, n, x, None if x is None else Decimal(f"{x:.2f}")))
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


ORDER = ["day", "n"]


def plain(frame=None):
    w = Window.partitionBy("k").orderBy(*ORDER)
    return w.rowsBetween(*frame) if frame else w


def by_n(df, *cols):
    return {r.n: tuple(r[c] for c in cols) for r in df.select("n", *cols).collect()}


def close(a, b):
    return a is None and b is None or a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_pieces_are_ranges_of_bounded_size(rows):
    d, cut = pieces.pieces(rows, "k", ORDER, 100)
    assert cut
    got = d.groupBy("k", pieces.PIECE).agg(F.count("*").alias("c"), F.min(F.struct(*ORDER)).alias("lo"), F.max(F.struct(*ORDER)).alias("hi")).collect()
    hot = sorted((r for r in got if r.k == "hot"), key=lambda r: r[pieces.PIECE])
    assert len(hot) >= 10 and max(r.c for r in hot) < 400
    for a, b in zip(hot, hot[1:]):
        assert d.select(F.lit(1)).limit(1).count() and tuple(x if x is not None else -99 for x in a.hi) < tuple(x if x is not None else -99 for x in b.lo)
    # the hot day alone is cut
    assert d.filter("k = 'hot' AND day = 5").select(pieces.PIECE).distinct().count() > 3
    small = {r.k for r in got if r[pieces.PIECE] > 0}
    assert small <= {"hot", None}


def test_search_of_splitters_is_compiled(rows, spark):
    """A step that is not compiled gets a copy of all its key's splitters with each row, so rows times pieces."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d, cut = pieces.pieces(rows, "k", ORDER, 37)
        plan = d.select("n", pieces.PIECE)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    steps = [line for line in plan.splitlines() if "Project" in line]
    assert cut and steps and all("*(" in line for line in steps), plan
    assert "lambda" not in plan


def test_many_steps_are_planned_at_once(spark):
    """Nothing above the search may name its steps one inside the other: three times the size with each, minutes with these."""
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    out = pieces.running(df, "k", "t", "t", "sum", "s", 2)
    began = time.monotonic()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    out._jdf.queryExecution().executedPlan()
    assert time.monotonic() - began < 20
    assert plan.count("__cuts") > 12 and "Generate" in plan


@pytest.mark.parametrize("size", [2, 5, 64])
def test_piece_is_the_number_of_splitters_ahead(rows, size):
    d, cut = pieces.pieces(rows, "k", ORDER, size)
    cuts = {r[pieces.KEY].k0: [(c.o0 is not None, c.o0 or 0, c.o1) for c in r.cuts] for r in pieces.splitters(pieces.keyed(rows, "k"), ORDER, size)[0].collect()}
    assert cut
    for r in d.collect():
        assert r[pieces.PIECE] == sum(c <= (r.day is not None, r.day or 0, r.n) for c in cuts.get(r.k, ()))


@pytest.mark.parametrize("fn", ["sum", "count", "max", "min"])
@pytest.mark.parametrize("size", [37, 100, 10_000])
def test_running_equals_plain(rows, fn, size):
    agg = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[fn]
    want = by_n(rows.withColumn("r", agg("d").over(plain((Window.unboundedPreceding, 0)))), "r")
    assert by_n(pieces.running(rows, "k", ORDER, "d", fn, "r", size), "r") == want


@pytest.mark.parametrize("descending", [False, True])
def test_last_equals_plain(rows, descending):
    cols = [F.col(c).desc() if descending else F.col(c) for c in ORDER]
    w = Window.partitionBy("k").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    sparse = rows.withColumn("x", F.when(F.col("n") % 50 == 0, F.col("x")))
    want = by_n(sparse.withColumn("r", F.last("x", ignorenulls=True).over(w)), "r")
    assert by_n(pieces.running(sparse, "k", ORDER, "x", "last", "r", 60, descending), "r") == want


def test_descending_sum_equals_plain(rows):
    w = Window.partitionBy("k").orderBy(*[F.col(c).desc() for c in ORDER]).rowsBetween(Window.unboundedPreceding, 0)
    want = by_n(rows.withColumn("r", F.sum("d").over(w)), "r")
    assert by_n(pieces.running(rows, "k", ORDER, "d", "sum", "r", 60, True), "r") == want


@pytest.mark.parametrize("size", [50, 10_000])
def test_shifted_equals_lag(rows, size):
    want = by_n(rows.withColumns({"prev_n": F.lag("n").over(plain()), "prev_x": F.lag("x").over(plain())}), "prev_n", "prev_x")
    assert by_n(pieces.shifted(rows, "k", ORDER, ["n", "x"], rows=size), "prev_n", "prev_x") == want


@pytest.mark.parametrize("fn,window,minp,shift", [("mean", 7, None, 0), ("mean", 7, 1, 0), ("std", 30, 5, 0), ("max", 20, None, 1), ("min", 90, 3, 2), ("sum", 1, 1, 0)])
@pytest.mark.parametrize("size", [40, 333])
def test_rolling_equals_plain(rows, fn, window, minp, shift, size):
    w = plain((-(window - 1) - shift, -shift))
    need = window if minp is None else minp
    want = by_n(rows.withColumn("r", F.when(F.count("x").over(w) >= need, pieces.ROLLING[fn]("x").over(w))), "r")
    got = by_n(pieces.rolling(rows, "k", ORDER, "x", fn, window, minp, shift, "r", size), "r")
    assert set(got) == set(want) and all(close(got[n][0], want[n][0]) for n in want)


def loop(xs, a, first_raw):
    y, out = None, []
    for x in xs:
        if x is None:
            out.append(None)
            continue
        x = x if math.isfinite(x) else math.nan
        y = (x if first_raw else x) if y is None else a * y + x
        out.append(y)
    return out


@pytest.mark.parametrize("a", [0.0, 0.3, -0.7, 0.9, 0.999, 1.0, -1.0, 1e-9])
@pytest.mark.parametrize("size", [None, 64])
def test_affine_equals_loop(rows, a, size):
    got = by_n(pieces.affine(rows, "k", ORDER, a, F.col("x"), None, "y", size), "y")
    series = {}
    for r in rows.collect():
        series.setdefault(r.k, []).append(((r.day is not None, r.day, r.n), r.n, r.x))
    for rs in series.values():
        rs.sort(key=lambda r: (r[0][0], r[0][1] or 0, r[0][2]))
        for (_, n, _), y in zip(rs, loop([r[2] for r in rs], a, True), strict=True):
            assert close(got[n][0], y), (a, n)


def test_affine_long_series_and_nan(spark):
    n = 6000
    df = spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias("t"), (F.col("id") % 17).cast("double").alias("x"))
    for a in (0.5, 0.99, 0.99999):
        got = [r.y for r in pieces.affine(df, "k", "t", a, F.col("x"), None, "y", 500).orderBy("t").collect()]
        want = loop([float(k % 17) for k in range(n)], a, True)
        assert all(math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-12) for g, w in zip(got, want, strict=True))
    bad = df.withColumn("x", F.when(F.col("t") == 3000, F.lit(float("nan"))).otherwise(F.col("x")))
    got = [r.y for r in pieces.affine(bad, "k", "t", 0.5, F.col("x"), None, "y", None).orderBy("t").collect()]
    assert not any(map(math.isnan, got[:3000])) and all(map(math.isnan, got[3000:]))
    with pytest.raises(ValueError):
        pieces.affine(df, "k", "t", 1.5, F.col("x"))


def test_ewma_and_discounted_sum_run_without_python(spark):
    df = spark.range(100).select(F.lit("a").alias("k"), F.col("id").alias("t"), F.col("id").cast("double").alias("x"))
    for out in (strategy.ewma(df, "k", "t", "x", 0.4), strategy.discounted_sum(df, "k", "t", "x", 0.9)):
        assert not any(w in out._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "Arrow"))
    got = [r.discounted for r in strategy.discounted_sum(df, "k", "t", "x", 0.9, split=10).orderBy("t").collect()]
    assert all(close(g, w) for g, w in zip(got, loop([float(k) for k in range(99, -1, -1)], 0.9, True)[::-1], strict=True))


def test_as_of_many_against_brute_force(spark):
    rng = random.Random(1)
    versions = [(rng.choice(["a", "a", "a", None, "b"]), rng.randrange(500) if rng.random() > 0.02 else None, v) for v in range(900)]
    asks = [(rng.choice(["a", "a", None, "c"]), rng.randrange(-5, 520) if rng.random() > 0.02 else None, q) for q in range(700)]
    v = spark.createDataFrame(versions, "k string, ts int, v int")
    q = spark.createDataFrame(asks, "k string, at int, q int")
    got = {r.q: (r.ts, r.v) for r in pieces.as_of_many(v, q, "k", "ts", "at", tie=["v"], rows=40).collect()}
    assert len(got) == len(asks)
    for k, at, n in asks:
        old = [] if at is None else [(t, x) for kk, t, x in versions if kk == k and t is not None and t <= at]
        assert got[n] == (max(old) if old else (None, None))


def test_hot_key_is_spread_over_tasks(spark):
    """A key with most rows must not sit in one partition of the window."""
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 100 + 1).otherwise(0).alias("k"), F.col("id").alias("t"))
    out = pieces.running(df, "k", "t", "t", "sum", "s", 1000)
    sizes = [r["count"] for r in out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    assert max(sizes) < 40_000 * 0.35
    assert out.agg(F.max("s")).first()[0] == sum(t for t in range(40_000) if t % 3)


def test_densify_with_split(spark):
    df = spark.createDataFrame([("a", "2020-01-01", 1.0), ("a", "2020-03-01", 2.0), ("b", "2020-01-05", None), ("b", "2020-01-09", 4.0)], "k string, d string, x double")
    df = df.withColumn("d", F.to_date("d"))
    assert sorted(map(str, ts.densify(df, "k", "d", ["x"], split=10).collect())) == sorted(map(str, ts.densify(df, "k", "d", ["x"]).collect()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int, x double")
    assert pieces.running(df, "k", "t", "x").count() == 0
    assert pieces.rolling(df, "k", "t", "x", "mean", 3).count() == 0
    assert pieces.affine(df, "k", "t", 0.5, F.col("x")).count() == 0


def test_affine_on_cut_keys_is_compiled(rows):
    """A row's number, which the recurrence starts from, comes from pieces; no step may copy the splitters to each row."""
    plan = pieces.affine(rows, "k", ORDER, 0.9, F.col("x"), None, "y", 37)._jdf.queryExecution().optimizedPlan().toString()
    assert "__cuts" in plan and "lambda" not in plan
