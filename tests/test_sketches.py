"""Stored daily sketches: merged windows against the rows themselves."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import sketches


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 6 + ["b", None]), f"2024-01-{rng.randrange(1, 31):02d} 10:00:00", None if rng.random() < 0.05 else round(rng.lognormvariate(0, 2), 4))
            for _ in range(20_000)]
    df = spark.createDataFrame(rows, "k string, t string, x double").withColumn("t", F.to_timestamp("t"))
    path = str(tmp_path_factory.mktemp("sketch") / "days")
    sketches.store_days(df, ["k"], "t", "x", path)
    # a day that comes again replaces itself
    sketches.store_days(df.filter(F.to_date("t") == "2024-01-12"), ["k"], "t", "x", path)
    return rows, path


@pytest.mark.parametrize("days", [1, 7, 30])
def test_window_from_days(spark, stored, days):
    rows, path = stored
    ranks = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r.k: r for r in sketches.over_window(spark, path, ["k"], "2024-01-30", days, ranks).collect()}
    for k in ("hot", "b", None):
        x = np.array([v for n, t, v in rows if n == k and v is not None and int(t[8:10]) > 30 - days])
        r = got[k]
        assert (r.n, r.least, r.largest) == (len(x), x.min(), x.max()) and abs(r["mean"] - x.mean()) < 1e-9
        for q, v in zip(ranks, r.quantiles, strict=True):
            assert (x < v).mean() <= q + 2 * sketches.rank_error() and (x <= v).mean() >= q - 2 * sketches.rank_error() - 1 / len(x)


def test_window_reads_its_days_only(spark, stored):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        sketches.over_window(spark, stored[1], ["k"], "2024-01-30", 7).explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(day" in buf.getvalue()
    sizes = spark.read.parquet(stored[1]).select(F.max(F.length("sketch"))).first()[0]
    assert sizes < 100_000


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "k string, t timestamp, x double")
    assert sketches.daily(df, ["k"], "t", "x").count() == 0
