"""Correlations, co-moments, Monte-Carlo draws and regressions against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import ml, stats


def pearson(x, y):
    x, y = np.array(x), np.array(y)
    if len(x) < 2 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return None
    return float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("key_block,date_block", [(256, 2048), (4, 5), (1, 1000)])
def test_corr_matrix_equals_numpy(spark, key_block, date_block):
    rng = random.Random(3)
    rows = []
    for k in range(17):
        for d in range(40):
            u = rng.random()
            if u < 0.7:
                rows.append((f"s{k}", d, 1e6 * k + rng.uniform(-1, 1) + (d if k % 2 else 0)))
            elif u < 0.75:
                rows.append((f"s{k}", d, None))
    rows += [("flat", d, 5.0) for d in range(40)] + [("one", 3, 1.0), (None, 3, 1.0), ("s1", None, 2.0)]
    rows += [("bad", d, math.nan if d == 39 else float(d)) for d in range(40)]
    got = {(r.a, r.b): r["corr"] for r in stats.corr_matrix(spark.createDataFrame(rows, "s string, d int, x double"), "s", "d", "x", key_block, date_block).collect()}
    series = {}
    for s, d, x in rows:
        if s is not None and d is not None and x is not None:
            series.setdefault(s, {})[d] = x
    names = sorted(series)
    want = {}
    for i, a in enumerate(names):
        for b in names[i:]:
            days = sorted(set(series[a]) & set(series[b]))
            if days:
                x, y = [series[a][d] for d in days], [series[b][d] for d in days]
                want[a, b] = math.nan if any(map(math.isnan, x + y)) else pearson(x, y)
    assert set(got) == set(want)
    for p, w in want.items():
        g = got[p]
        assert (g is None) == (w is None) and (w is None or math.isnan(w) and math.isnan(g) or abs(g - w) < 1e-9), (p, g, w)


def test_corr_matrix_pairs_no_rows(spark):
    """500 keys: what is joined is a block with a block, not a row with a row."""
    df = spark.range(500 * 12).select((F.col("id") % 500).alias("k"), (F.col("id") / 500).cast("int").alias("d"), F.rand(1).alias("x"))
    out = stats.corr_matrix(df, "k", "d", "x")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan
    assert out.count() == 500 * 501 // 2


def test_comoments_merge_to_the_whole(spark):
    rng = np.random.default_rng(1)
    n = 3000
    x = rng.normal(1e6, 1, n)  # a large mean: sums of squares would lose all digits
    y = 2 * x + rng.normal(0, 1, n)
    rows = [(int(g), None if g == 3 and k % 5 == 0 else float(a), float(b)) for k, (g, a, b) in enumerate(zip(rng.integers(0, 30, n), x, y, strict=True))]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    parts = stats.comoments(df, ["g"], "x", "y")
    coarse = stats.merge_comoments(parts.withColumn("h", F.col("g") % 4), ["h"])
    got = {r.h: (r.n, r.c) for r in coarse.select("h", "n", stats.corr_of().alias("c")).collect()}
    for h in range(4):
        pick = [(a, b) for g, a, b in rows if g % 4 == h and a is not None]
        assert got[h][0] == len(pick) and abs(got[h][1] - pearson(*zip(*pick))) < 1e-9
    whole = stats.merge_comoments(coarse, []).select("n", stats.corr_of().alias("c")).first()
    every = [(a, b) for _, a, b in rows if a is not None]
    assert whole.n == len(every) and abs(whole.c - pearson(*zip(*every))) < 1e-9
    assert stats.comoments(df.limit(0), ["g"], "x", "y").count() == 0


def test_draws_do_not_depend_on_the_layout(spark):
    st = spark.createDataFrame([("a", 100.0, 0.001, 0.02), ("b", 50.0, 0.0, 0.01)], "s string, p double, m double, v double")
    seen = []
    for parts in (2, 37):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        seen.append(sorted((r.s, round(r.mean_final, 9), round(r.q_final, 9)) for r in stats.var_mc(
            st, "s", "p", "m", "v", days=20, runs=500).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1]
    z = np.array([r.z for r in spark.range(20_000).select(stats.hashed_normal(F.lit(1), F.col("id")).alias("z")).collect()])
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03 and abs((z ** 4).mean() - 3) < 0.3


def test_regression_equals_numpy(spark):
    rng = random.Random(9)
    effect = {"a": 0.0, "b": 2.0, "c": -1.0, None: 5.0}
    rows = []
    for _ in range(600):
        u, v = rng.choice(list(effect)), rng.randrange(6)
        rows.append((u, v, 10 + effect[u] + 0.5 * v + rng.gauss(0, 1)))
    rows.append(("a", 0, None))
    df = spark.createDataFrame(rows, "u string, v int, y double")
    model = ml.linreg(df, "y", ["u", "v"])
    us, vs = [None, "a", "b", "c"], [str(k) for k in range(6)]
    design = np.array([[1.0] + [u == x for x in us[1:]] + [str(v) == x for x in vs[1:]] for u, v, y in rows if y is not None], float)
    y = np.array([y for *_, y in rows if y is not None])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    got = {(r.u, r.v): r.predicted_y for r in model.predict(df).collect()}
    for (u, v, t), p in zip([r for r in rows if r[2] is not None], design @ beta, strict=True):
        assert abs(got[u, v] - p) < 1e-8
    assert model.n_coefficients == 8
    m = ml.evaluate_regression(model, df, df, "m").first()
    res = y - design @ beta
    assert abs(m.rmse - math.sqrt((res ** 2).mean())) < 1e-8 and abs(m.mae - np.abs(res).mean()) < 1e-8
    assert abs(m.r2 - (1 - (res ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-8 and (m.n_train, m.n_test) == (600, 600)
    # a level that was not trained on adds nothing; levels that always come together are no obstacle
    assert model.predict(spark.createDataFrame([("new", 0, 0.0)], "u string, v int, y double")).first().predicted_y == pytest.approx(model.intercept)
    twice = ml.linreg(df.withColumn("w", F.col("u")), "y", ["u", "w", "v"])
    assert abs(twice.predict(df.withColumn("w", F.col("u"))).orderBy("u", "v").first().predicted_y - model.predict(df).orderBy("u", "v").first().predicted_y) < 1e-6
    assert ml.linreg(df.limit(0), "y", ["u", "v"]).n_coefficients == 0


def test_pair_counts_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("u"), (F.col("id") % 5).alias("v"), F.col("id").cast("double").alias("y"), (F.col("id") % 2).alias("part"))
    whole = {tuple(r[:4]): (r.n, r.s) for r in ml.pair_counts(df, "y", ["u", "v"]).collect()}
    total = {}
    for p in (0, 1):
        for r in ml.pair_counts(df.filter(F.col("part") == p), "y", ["u", "v"]).collect():
            n, s = total.get(tuple(r[:4]), (0, 0.0))
            total[tuple(r[:4])] = (n + r.n, s + r.s)
    assert whole == total
