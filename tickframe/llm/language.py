"""Language identification by averaged hashed subword embeddings.

A text's features are its hashed byte trigrams and 4-grams (ASCII lower-cased,
ASCII other than letters as blanks, grams whose second byte is a blank left
out).  The text is the mean of their embeddings, a linear softmax on it gives
the language; embeddings and layer are trained together by mini-batch
stochastic gradient descent in numpy.  A temperature fitted on a held-back
part of the training sample calibrates the probabilities.

A probability among the learned languages says nothing about a text in none
of them, so the score is the probability times the text's *fit*: the share of
its grams that are typical of the language (more frequent there than the
average gram), on a scale from 0 for grams at random to 1 for what all but
``MISFITS`` of the rightly classified held-back rows reach.  The rejection
threshold is ``LEAST_SCORE``, or more where the accepted held-back rows would
have over ``TARGET_ERROR`` errors; when no cut meets that, nothing is accepted.

Training sees a bounded sample (``PER_LANGUAGE`` documents of each language,
those with the smallest id hashes); what reaches the driver is their hashed
counts, at most ``BUCKETS`` numbers each.  Prediction reads whole texts.

Null texts and texts without a letter are ``und`` with score 0; so are all
texts when there is nothing to learn from.  Equal texts get equal answers;
ties go to the language first in order.  Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, pretokens

BUCKETS = 1 << 13
DIMENSIONS = 16
#: Documents of each language in the training sample; the bound of what is learned from.
PER_LANGUAGE = 400
EPOCHS, BATCH, RATE = 10, 32, 4.0
TARGET_ERROR = 0.01
#: Part of the rightly classified held-back rows that may have a fit below 1.
MISFITS = 0.01
#: Scores below are rejected in any case.
LEAST_SCORE = 0.75
UNDETERMINED = "und"
#: Text bytes handled at a time; a gram takes some 60 bytes of working memory.
SLICE_BYTES = 1 << 20

_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[:128] = 32
_TABLE[97:123] = _TABLE[65:91] = np.arange(97, 123)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all grams of an array of texts, and each gram's text."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    size = np.diff(ends) + 3  # a blank before and two after each text, so that grams stay inside
    at = pretokens.starts(size)
    b = np.full(at[-1], 32, np.uint8)
    owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
    b[np.arange(len(raw)) + 3 * owner_of(ends) + 1] = _TABLE[raw]
    x = b.astype(np.uint32)
    tri = x[:-3] * np.uint32(0x9E3779B1) + x[1:-2] * np.uint32(0x85EBCA77) + x[2:-1] * np.uint32(0xC2B2AE3D)
    four = (tri ^ (x[3:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = (x[1:-2] != 32) & (owner[:-3] == owner[2:-1])
    inside4 = inside & (owner[:-3] == owner[3:])
    tri = ((tri * np.uint32(0x2545F491)) >> shift)[inside]
    return np.concatenate([tri, (four >> shift)[inside4]]), np.concatenate([owner[:-3][inside], owner[:-3][inside4]])


def owner_of(ends: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (BUCKETS, languages): each embedding through the layer
    bias: np.ndarray
    temperature: float
    threshold: float
    typical: np.ndarray  # (BUCKETS, languages): whether a gram is typical of the language
    usual: float  # share of typical grams from which the fit is 1

    def fit_of(self, share: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Fit of texts to their languages by their shares of typical grams."""
        random = self.typical.mean(0)[best]
        return np.clip((share - random) / np.maximum(self.usual - random, 1e-9), 0, 1)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bucket, owner = grams(texts)
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        logits = np.stack([np.bincount(owner, self.scores[:, k][bucket], len(texts)) / n for k in range(len(self.languages))], 1)
        p = softmax((logits + self.bias) / self.temperature)
        best = p.argmax(1)
        names = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters, strict=True)]
        share = np.bincount(owner, self.typical[bucket, best[owner]], len(texts)) / n
        return names, np.where(letters, p[np.arange(len(p)), best] * self.fit_of(share, best), 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(counts: np.ndarray, labels: list[str], seed: int = 0) -> Model:
    """Train on rows of gram counts; every fifth row is held back for calibration."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, np.inf, np.zeros((BUCKETS, 0), bool), 1.0)
    y = np.searchsorted(languages, labels)
    x = (counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)
    back = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    rows = np.flatnonzero(~back)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for k in range(0, len(rows), BATCH):
            take = rng.choice(rows, min(BATCH, len(rows)), replace=False)
            xb, v = x[take], x[take] @ emb
            g = softmax(v @ layer + bias)
            g[np.arange(len(take)), y[take]] -= 1
            g /= len(take)
            grad = v.T @ g
            # a bucket's share of a text is small, so embeddings take larger steps
            emb -= rate * 50 * (xb.T @ (g @ layer.T))
            layer -= rate * grad
            bias -= rate * 0.1 * g.sum(0)
    check = np.flatnonzero(back) if back.any() else rows
    z = x[check] @ emb @ layer + bias
    truth = y[check]

    def loss(t: float) -> float:
        return -np.log(softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min(np.geomspace(0.01, 20, 60), key=loss)
    total = np.stack([counts[rows[y[rows] == k]].sum(0, dtype=np.float64) for k in range(len(languages))], 1)
    typical = (total > 0) & (total * BUCKETS >= total.sum(0))
    p = softmax(z / temperature)
    best = p.argmax(1)
    wrong = best != truth
    share = (counts[check] * typical.T[best]).sum(1) / np.maximum(counts[check].sum(1), 1)
    usual = float(np.quantile(share[~wrong], MISFITS)) if not wrong.all() else 1.0
    model = Model(languages, (emb @ layer).astype(np.float64), bias.astype(np.float64), float(temperature), np.inf, typical, usual)
    score = p.max(1) * model.fit_of(share, best)
    order = np.argsort(-score, kind="stable")
    errors = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    # equal scores are accepted together
    ends = np.append(score[order][1:] != score[order][:-1], True)
    good = np.flatnonzero((errors <= TARGET_ERROR) & ends)
    if len(good):
        model.threshold = LEAST_SCORE if good[-1] == len(order) - 1 else max(LEAST_SCORE, float(score[order[good[-1]]]))
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows of ``df`` that are not held out and have a text and a language."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    picked = rows.select("id", "lang", F.xxhash64("id").alias("h")).distinct()
    picked = common.least_hashed(picked, "lang", PER_LANGUAGE).select("id", "lang")
    # bounded: PER_LANGUAGE ids of each language
    sample = rows.join(F.broadcast(picked), ["id", "lang"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, "text", SLICE_BYTES):
                bucket, owner = grams(part.column("text"))
                key, n = np.unique(owner.astype(np.int64) * BUCKETS + bucket, return_counts=True)
                per = pretokens.starts(np.bincount(key // BUCKETS, minlength=part.num_rows))
                lists = [pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(v.astype(np.int32))) for v in (key % BUCKETS, n)]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("lang"), *lists], ["id", "lang", "bucket", "n"])

    schema = T.StructType([sample.schema["id"], sample.schema["lang"], T.StructField("bucket", T.ArrayType(T.IntegerType())),
                           T.StructField("n", T.ArrayType(T.IntegerType()))])
    got = sample.mapInArrow(features, schema).dropDuplicates(["id"]).toArrow().sort_by("id")
    counts = np.zeros((got.num_rows, BUCKETS), np.float32)
    for k, (b, n) in enumerate(zip(got["bucket"], got["n"], strict=True)):
        counts[k, b.values.to_numpy()] = n.values.to_numpy()
    return fit(counts, got["lang"].to_pylist())


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score."""
    keep = [c for c in df.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, text, SLICE_BYTES):
                names, score = model.predict(part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(names, pa.string()), pa.array(score)],
                                                 [*keep, "lang_pred", "score"])
            common.tidy()

    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    out = predict(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
