"""Hard-negative mining against brute force; the interval must hold for every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, d int"


def brute(rows, every: int = 100) -> list[tuple]:
    known: dict = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = (str(label), tuple(np.float32(c) for c in v))
        if i not in known or x < known[i]:
            known[i] = x
    whole = {i: (label, [math.floor(256 * float(c)) for c in v]) for i, (label, v) in known.items()}
    out = []
    for a, (label, q) in whole.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, v, strict=True)) for i, (_, v) in whole.items() if i != a and len(v) == len(q)}
        first = sorted((i for i in score if whole[i][0] == label), key=lambda i: (-score[i], i))[:5]
        for p in first:
            neg = [i for i in score if whole[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            for r, n in enumerate(sorted(neg, key=lambda i: (-score[i], i))[:10], 1):
                out.append((a, p, r, n, score[p], score[n]))
    return sorted(out)


def vectors(seed: int, n: int, d: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    out = []
    for i in range(n):
        c = int(rng.integers(6))
        v = centres[c] + rng.normal(size=d) * rng.choice([0.05, 0.5, 2])
        out.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(4)) if i % 3 else c))
    return out


def mined(spark, rows, **kw) -> list[tuple]:
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA).repartition(3)
    out = hn.mine(df, F.col("id") % kw.pop("every", 100) == 0, **kw)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("d", [1, 3, 64, 100])
def test_interval_holds(d):
    rng = np.random.default_rng(d)
    x, q = np.floor(rng.normal(size=(400, d)) * 300), np.floor(rng.normal(size=(30, d)) * 300)
    x[:5], q[:1] = 0, 0
    x[5:10] = q[5:10]
    low, high = hn.Anchors(q).interval(slice(0, 30), hn.Codes.of(x))
    truth = q @ x.T
    assert (low <= truth).all() and (truth <= high).all()
    if d >= 64:  # and is narrow enough to leave most rows out
        reach = np.sqrt((q * q).sum(1))[1:, None] * np.sqrt((x * x).sum(1))[None, 5:]
        assert np.median((high - low)[1:, 5:] / reach) < 0.7


@pytest.mark.parametrize("d", [2, 24, 64])
def test_against_brute_force(spark, d):
    rows = vectors(d, 900, d)
    want = brute(rows, 30)
    assert len(want) > 100
    assert mined(spark, rows, every=30) == want


def test_blocks_hot_label_and_ties(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROW_BLOCK", 50)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 3)
    rng = random.Random(3)
    # few distinct vectors, so that scores tie; one label holds most rows
    few = [[rng.choice([0.5, -0.25, 1.0]) for _ in range(8)] for _ in range(12)]
    rows = [(i, few[rng.randrange(12)], 1 if rng.random() < 0.7 else rng.randrange(5)) for i in range(500)]
    assert mined(spark, rows, every=20) == brute(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(1, 150, 4)
    rows += [(200, None, 1), (300, [1.0, None, 0.0, 0.0], 1), (400, [nan, 0.0, 0.0, 1.0], 2), (500, [inf, 0.0, 0.0, 1.0], 2),
             (600, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0, 2.0, 3.0, 4.0], 1), (700, [], 1), (701, [], 1), (702, [], 2),
             (800, [1.0, 2.0], 1), (801, [1.0, 2.5], 1), (802, [0.5, 1.0], 2), (900, [0.0] * 4, 3)]
    rows += [rows[0], rows[7], (10, [1.0, 1.0, 1.0, 1.0], 0)]  # repeated ids
    want = brute(rows, 10)
    assert any(r[0] == 800 for r in want) and any(r[0] == 700 for r in want)
    assert mined(spark, rows, every=10) == want


def test_large_components_and_empty_table(spark):
    rows = [(i, [float(10 ** (i % 3 + 3)), 1.0 + i, -float(i)], i % 2) for i in range(60)]
    assert mined(spark, rows, every=10) == brute(rows, 10)
    assert np.array_equal(hn.scores(np.array([2.0 ** 30, 3.0]), np.array([[2.0 ** 24, 5.0], [2.0 ** 40, -1.0]])), [2 ** 54 + 15, 2 ** 63 - 1])
    assert mined(spark, []) == []


def test_query_registered_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in hn.op12_hard_negatives(spark, sf).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got and got == sorted(con.execute(hn.SQL).fetchall())
