"""Toxicity: held-out accuracy, misspellings, and every odd row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickframe.llm import language, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_rows(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(language.held_out(F.col("doc_id")))
    out = toxicity.predict(docs.select("doc_id", "text"), model).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    toxic, clean = out[out.toxic == 1], out[out.toxic == 0]
    # some 330 toxic documents are learned from; the check tables have thousands, and there nearly all are found
    assert len(toxic) > 50 and toxic.predicted.mean() >= 0.85
    assert clean.predicted.mean() <= 0.05
    assert out.score.between(0, 1).all()


def test_grams_by_hand():
    """Grams of a word are those of the word alone, whatever stands beside it."""
    words = ["abc", "", "a", "abcdef", "é", "abc"]
    bucket, owner = toxicity.grams(pa.array(words))
    for k, w in enumerate(words):
        alone, _ = toxicity.grams(pa.array([w]))
        assert sorted(bucket[owner == k]) == sorted(alone)
        size = len(w.encode()) + 2
        assert len(alone) == (sum(max(0, size - n + 1) for n in (3, 4, 5)) + 1 if w else 0)


def test_windows_against_loop(model):
    rng = np.random.default_rng(2)
    pool = ["the", "of", "idiot", "moronic", "losers!", "thin", "a", "and,", "..."]
    texts = [" ".join(rng.choice(pool, rng.integers(1, 90))) for _ in range(40)] + ["", None, " \n ", "the the the the"]
    got, place = model.logits(pa.array(texts))
    for t, z, p in zip(texts, got, place, strict=True):
        words = (t or "").split()
        runs = [(k, w) for k, w in enumerate(words) if k == 0 or words[k - 1] != w]
        cleaned = [(k, w.lower().strip(toxicity.ENDS)) for k, w in runs]
        best = []
        for k in range(0, len(cleaned), toxicity.HALF):
            b, _ = toxicity.grams(pa.array([w for _, w in cleaned[k:k + 2 * toxicity.HALF]]))
            best.append((model.weight[b].sum() / max(len(b), toxicity.LEAST_GRAMS) + model.bias, cleaned[k][0]))
        if not best:
            assert np.isnan(z)
            continue
        assert z == pytest.approx(max(v for v, _ in best), abs=1e-9)
        assert any(abs(v - z) < 1e-9 and k == p for v, k in best)


def test_misspelt_and_hidden_in_long_texts(spark, model):
    clean = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0"), "doc_id")
    base = clean.filter("lang = 'en' AND length(text) BETWEEN 300 AND 2000").orderBy("doc_id").select("text").limit(30).toPandas()["text"].tolist()
    quiet, _ = model.scores(pa.array(base))
    assert (quiet < toxicity.THRESHOLD).mean() >= 0.95
    around = " ".join(base)
    calm = model.scores(pa.array([f"{around} what a {around}"]))[0][0]
    words, caught = ("idiott", "stuppid", "morons", "pathetik", "trashy"), 0
    for word in words:  # none of them is in the table
        loud, place = model.scores(pa.array([f"{around} what a {word} {around}", f"{base[0][:60]} {word}"]))
        assert loud[1] > calm and loud[0] >= calm
        caught += loud[0] >= toxicity.THRESHOLD
        if loud[0] >= toxicity.THRESHOLD:
            before = len(f"{around} what a".split())
            assert place[0] <= before < place[0] + 4 * toxicity.HALF
    assert caught >= 3 and calm < toxicity.THRESHOLD


def test_odd_rows_and_tables(spark):
    rows = [(k, f"plain words number {k} of this text" + (" you total nitwit" if k % 2 else ""), k) for k in range(200)]
    rows += [(500, None, 1), (501, "", 1), (502, " \n\t", 1), (503, "x" * 100_000, 1), (504, "nitwit " * 30_000, 1), (None, "plain words", 2), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int").withColumn("predicted", F.lit("clash"))
    labels = spark.createDataFrame([(k, k % 2, 9) for k in range(200)] + [(1, 0, 9), (3, None, 9), (4, 7, 9), (None, 1, 9), (999, 1, 9)],
                                   "doc_id long, toxic int, text int")
    model = toxicity.train(docs, labels)
    out = toxicity.predict(docs, model).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"doc_id", "score", "predicted", "peak_word"}
    by = {r["doc_id"]: r for r in out}
    assert all(by[k]["predicted"] == k % 2 for k in range(200))
    assert by[500]["score"] == by[501]["score"] == by[502]["score"] == pytest.approx(model.share)
    assert by[504]["predicted"] == 1 and 0 <= by[503]["score"] <= 1
    one = toxicity.train(docs, labels.filter("toxic = 1"))
    assert one.share == 1 and toxicity.predict(docs, one).filter("score <> 1").count() == 0
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.predict(docs, none).filter("score <> 0").count() == 0
    assert toxicity.predict(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), labels).share == 0


def test_held_out_rows_are_never_learned_from(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", language.held_out(F.col("doc_id")).cast("int").alias("toxic"))
    # all toxic labels are on held-out rows
    assert toxicity.train(docs, labels).share == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    out = toxicity.op13_toxicity(spark, path)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
