"""Exact skew-safe quantiles against Spark's percentile and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators.quantiles import exact_percentiles
from tickframe.sources.tables import table

from conftest import SF_SMALL

QS = [0.0, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("final_rows", [10, 200_000])
def test_matches_percentile_with_hot_group(spark, final_rows):
    e = table(spark, SF_SMALL, "events")
    # one group holds most rows, values continuous
    g = e.select(F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(F.lit("hot")).alias("k"),
                 (F.col("value") * F.sqrt(F.col("event_id") + 1)).alias("v"))
    got = {(r["k"], r["q"]): r["v"] for r in exact_percentiles(g, ["k"], "v", QS, buckets=8, final_rows=final_rows).collect()}
    exp = {}
    for r in g.groupBy("k").agg(F.percentile("v", QS).alias("p")).collect():
        for q, v in zip(QS, r["p"]):
            exp[(r["k"], q)] = v
    assert set(got) == set(exp)
    for key, v in exp.items():
        assert abs(got[key] - v) <= 1e-9 * max(1.0, abs(v)), key


def test_constant_and_tiny_groups(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("b", 2.0), ("c", None), ("c", 5.0), ("c", 7.0)], "k string, v double")
    got = {(r["k"], r["q"]): r["v"] for r in exact_percentiles(df, ["k"], "v", [0.5, 0.25], buckets=4, final_rows=3).collect()}
    assert got[("a", 0.5)] == 1.0 and got[("b", 0.25)] == 2.0
    assert got[("c", 0.5)] == 6.0 and got[("c", 0.25)] == float(np.percentile([5.0, 7.0], 25))


def test_rows_of_a_value_that_fills_a_node_are_not_kept(spark, monkeypatch):
    """A value of many rows is its own quantile: its rows are not carried on, nor gathered in one task."""
    rows = [("a", 7.0)] * 300 + [("a", float(x)) for x in range(40)] + [("b", 3.0)] * 500 + [(None, 2.0)] * 90 + [("c", float(x)) for x in range(5)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    kind, kept = type(df), []
    plain = kind.checkpoint

    def counted(self, *args, **kwargs):
        out = plain(self, *args, **kwargs)
        if "__v" in out.columns:
            kept.append(out.groupBy("__v").count().agg(F.max("count")).first()[0] or 0)
        return out
    monkeypatch.setattr(kind, "checkpoint", counted)
    hot = df.filter("k = 'a'")
    got = {r["q"]: r["v"] for r in exact_percentiles(hot, ["k"], "v", QS, buckets=4, final_rows=20).collect()}
    x = np.array([v for k, v in rows if k == "a"])
    assert got == {q: float(np.quantile(x, q)) for q in QS}
    assert kept and kept[-1] <= 20
    got = {(r["k"], r["q"]): r["v"] for r in exact_percentiles(df, ["k"], "v", QS, buckets=4, final_rows=20).collect()}
    want = {(k, q): float(np.quantile([v for n, v in rows if n == k], q)) for k in ("a", "b", "c", None) for q in QS}
    assert got == want


def test_rows_meet_large_nodes_by_broadcast(spark, monkeypatch):
    """Nodes of most rows are joined by broadcast, whatever Spark knows of their size."""
    df = spark.range(2000).select((F.col("id") % 2).alias("k"), F.sqrt("id").alias("v"))
    kind, plans = type(df), []
    plain = kind.checkpoint

    def seen(self, *args, **kwargs):
        if "__v" in self.columns:
            plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return plain(self, *args, **kwargs)
    monkeypatch.setattr(kind, "checkpoint", seen)
    got = {(r["k"], r["q"]): r["v"] for r in exact_percentiles(df, ["k"], "v", [0.5], buckets=8, final_rows=50).collect()}
    for k in (0, 1):
        assert abs(got[k, 0.5] - np.quantile(np.sqrt(np.arange(k, 2000, 2)), 0.5)) < 1e-9
    assert plans and all("LeftAnti" in p and "rightHint=(strategy=broadcast)" in p for p in plans)
