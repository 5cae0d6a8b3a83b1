"""Toxicity by averaged subword embeddings and a linear softmax.

A word (blank-separated, lower-cased, without punctuation at its ends) is a
bag of hashed byte 3-, 4- and 5-grams, its ends marked, and of itself as a
whole.  A window of words is the average of their embeddings (over
``LEAST_GRAMS`` at least, as if the rest were empty); a linear softmax on it
tells toxic from clean.  Embeddings and layer are trained together in
numpy by stochastic gradient descent (AdaGrad steps), so a misspelt or inflected
word that was never seen still lies where the grams it shares put it.

A document is as toxic as its worst window of ``2 * HALF`` words, so one insult
in a very long text counts as much as in a short one.  Only documents carry
labels; training therefore first takes every window with its document's label
and then, round by round, the worst window of each document (and some of
clean ones at random).  Held-back documents fit a logistic curve from worst-window
logits to probabilities under the classes' real shares.

Training sees a bounded sample: ``PER_CLASS`` documents of each class, those
with the least id hashes, at most ``TRAIN_WINDOWS`` windows of each, evenly
spread over the whole text, words cut at ``TRAIN_WORD`` bytes.  Prediction
reads whole texts.

Null and empty texts, and texts without a word, get the toxic share of the
labelled documents.  With nothing to learn from, or one class only, all scores
are that share (0 without labels).  An id with several labels is toxic if one of
them is; labels other than 0 and 1 are ignored; of several texts of an id the
least is learned from.  Rows are judged on their own, equal texts get equal
scores, other columns pass through; a column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, language, pretokens

BUCKETS = 1 << 16
DIMENSIONS = 8
#: Words of half a window; windows overlap by half.
HALF = 2
#: An average is over so many grams at least.
LEAST_GRAMS = 40
#: Bounds of the training sample.
PER_CLASS, TRAIN_WINDOWS, TRAIN_WORD = 2000, 160, 40
#: Windows of the first round, and windows of clean documents in each later one.
FIRST_ROUND, CLEAN_WINDOWS = 20_000, 1_000
ROUNDS, BATCH, RATE = 24, 64, 0.2
THRESHOLD = 0.3
ENDS = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—¡¿*_"


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the grams of an array of words, and each gram's word."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = words.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    # one mark before and after each word; no gram reaches past them
    size = np.diff(ends) + 2
    at = pretokens.starts(size)
    x = np.full(at[-1], 1, np.uint32)
    owner = np.repeat(np.arange(len(size)), size)
    x[np.arange(len(raw)) + 2 * np.repeat(np.arange(len(size)), np.diff(ends)) + 1] = raw
    place = np.arange(at[-1]) - at[:-1][owner]
    left = size[owner] - place  # bytes of the word from here on, marks counted
    empty = (size == 2)[owner]
    buckets, owners = [], []
    h, far = np.zeros(at[-1], np.uint32), np.append(x, np.zeros(4, np.uint32))
    whole = np.zeros(len(size), np.uint32)
    # a word as a whole: a sum of its bytes by place
    np.add.at(whole, owner, (x + 1) * (place.astype(np.uint32) * np.uint32(0x9E3779B1) | np.uint32(1)))
    for n in range(5):
        h = (h ^ far[n:n + len(h)]) * np.uint32(0x01000193) + np.uint32(n)
        if n >= 2:
            ok = (left > n) & ~empty
            buckets.append(h[ok] * np.uint32(0x85EBCA6B) >> np.uint32(33 - BUCKETS.bit_length()))
            owners.append(owner[ok])
    buckets.append((whole * np.uint32(0xC2B2AE35) >> np.uint32(33 - BUCKETS.bit_length()))[size > 2])
    owners.append(np.flatnonzero(size > 2))
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Words per text, the code of each in order, the distinct words, lower-cased and trimmed, and each word's place.

    A run of one word counts once.
    """
    n, codes, values = pretokens._coded(pc.utf8_split_whitespace(pc.fill_null(texts, "")))
    owner = np.repeat(np.arange(len(n)), n)
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    place = np.arange(len(codes)) - pretokens.starts(n)[owner]
    words = pc.utf8_trim(pc.utf8_lower(pa.array(values, pa.string())), ENDS)
    return np.bincount(owner[new], minlength=len(n)), codes[new], words, place[new]


def _halves(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each half window begins in the words of all texts, and half windows per text."""
    per = -(-n // HALF)
    first = pretokens.starts(n)[:-1]
    at = np.repeat(first - HALF * pretokens.starts(per)[:-1], per) + HALF * np.arange(per.sum())
    return at, per


@dataclass
class Model:
    weight: np.ndarray  # (BUCKETS): each embedding through the layer, toxic less clean
    bias: float
    slope: float
    offset: float
    share: float  # of toxic documents among the labelled ones

    def logits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The worst window's logit of each text (NaN without words), and its first word."""
        n, codes, words, where = words_of(texts)
        bucket, owner = grams(words)
        total = np.bincount(owner, self.weight[bucket], len(words))
        count = np.bincount(owner, minlength=len(words))
        out, place = np.full(len(n), np.nan), np.zeros(len(n), np.int64)
        at, per = _halves(n)
        if not len(at):
            return out, place
        s, c = np.add.reduceat(total[codes], at), np.add.reduceat(count[codes], at)
        first = pretokens.starts(per)
        # each half window with the next one of the same text
        more = np.ones(len(at), bool)
        more[first[1:][per > 0] - 1] = False
        s, c = s + np.where(more, np.append(s[1:], 0), 0), c + np.where(more, np.append(c[1:], 0), 0)
        z = s / np.maximum(c, LEAST_GRAMS) + self.bias
        has = np.flatnonzero(per > 0)
        out[has] = np.maximum.reduceat(z, first[:-1][has])
        owner = np.repeat(np.arange(len(n)), per)
        peak = np.flatnonzero(z == out[owner])[::-1]
        place[owner[peak]] = where[at[peak]]
        return out, place

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        z, place = self.logits(texts)
        if not self.weight.any():  # nothing was learned
            return np.full(len(z), self.share), place
        p = 1 / (1 + np.exp(-np.clip(self.slope * np.nan_to_num(z) + self.offset, -500, 500)))
        return np.where(np.isnan(z), self.share, p), place


def _curve(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve; smoothed targets keep it finite when classes part."""
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([z, np.ones(len(z))], 1)
    w = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])

    def loss(w: np.ndarray) -> float:
        v = x @ w
        return (weight * (np.logaddexp(0, v) - t * v)).sum() + 1e-3 * w[0] ** 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (weight * (p - t)) + [2e-3 * w[0], 0]
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([2e-3, 1e-9])
        step = np.linalg.solve(bend, grad)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        if size <= 1e-6 or np.abs(size * step).max() < 1e-9:
            break
        w = w - size * step
    return float(max(w[0], 0.0)), float(w[1])


def fit(windows: list[list[list[str]]], labels: np.ndarray, classes: np.ndarray, seed: int = 0) -> Model:
    """Train on documents given as windows of words; every fifth is held back for the curve."""
    share = float(classes[1] / classes.sum()) if classes.sum() else 0.0
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 0.0, 0.0, 0.0, share)
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(windows)), [len(w) for w in windows])
    flat = [w for d in windows for w in d]
    words = pa.array([x for w in flat for x in w], pa.string()).dictionary_encode()
    bucket, owner = grams(words.dictionary)
    order = np.argsort(owner, kind="stable")
    bucket, at = bucket[order].astype(np.int32), pretokens.starts(np.bincount(owner, minlength=len(words.dictionary)))
    codes = words.indices.to_numpy()
    per_window = np.bincount(np.repeat(np.arange(len(flat)), [len(w) for w in flat]), np.diff(at)[codes], len(flat)).astype(np.int64)
    gram = pretokens.ragged(bucket, at, codes)
    start = pretokens.starts(per_window)
    usable = per_window > 0
    over = np.maximum(per_window, LEAST_GRAMS).astype(np.float64)
    emb = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS))
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.zeros(2)
    seen_emb, seen_layer, seen_bias = np.full(BUCKETS, 1e-8), np.full(layer.shape, 1e-8), np.full(2, 1e-8)
    y = labels[doc]

    def step(take: np.ndarray) -> None:
        size = per_window[take]
        ids = gram[np.repeat(start[take] - pretokens.starts(size)[:-1], size) + np.arange(size.sum())]
        who = np.repeat(np.arange(len(take)), size)
        distinct, slot = np.unique(ids, return_inverse=True)
        rows = emb[distinct]
        v = np.stack([np.bincount(who, rows[slot, k], len(take)) for k in range(DIMENSIONS)], 1) / over[take][:, None]
        g = language.softmax(v @ layer + bias)
        g[np.arange(len(take)), y[take]] -= 1
        g /= len(take)
        back = (g @ layer.T) / over[take][:, None]
        grad = np.stack([np.bincount(slot, back[who, k], len(distinct)) for k in range(DIMENSIONS)], 1)
        seen_emb[distinct] += (grad * grad).mean(1)
        emb[distinct] -= RATE * grad / np.sqrt(seen_emb[distinct])[:, None]
        for w, seen, d in ((layer, seen_layer, v.T @ g), (bias, seen_bias, g.sum(0))):
            seen += d * d
            w -= RATE * d / np.sqrt(seen)

    def logits() -> np.ndarray:
        weight = (emb @ (layer[:, 1] - layer[:, 0]))
        z = np.zeros(len(flat))
        z[usable] = np.add.reduceat(weight[gram], start[:-1][usable]) / over[usable]
        return np.where(usable, z + bias[1] - bias[0], -np.inf)

    def worst(z: np.ndarray) -> np.ndarray:
        """The window of each document with the largest logit."""
        last = np.lexsort((z, doc))
        return last[np.append(doc[last][1:] != doc[last][:-1], True)]

    # a fifth of each class is held back
    rank = np.zeros(len(labels), np.int64)
    for c in (0, 1):
        rank[labels == c] = np.arange((labels == c).sum())
    learn = rank % 5 != 4
    every = np.flatnonzero(usable & learn[doc])
    for r in range(ROUNDS):
        if r == 0:
            # toxic and clean windows alike often
            pools = [every[y[every] == c] for c in (0, 1)]
            rows = np.concatenate([rng.choice(p, FIRST_ROUND // 2) for p in pools if len(p)])
        else:
            top = worst(logits())
            top = top[usable[top] & learn[doc[top]]]
            clean = every[y[every] == 0]
            rows = np.concatenate([top, rng.choice(clean, min(len(clean), CLEAN_WINDOWS), replace=False)])
        rows = rng.permutation(rows)
        for k in range(0, len(rows), BATCH):
            step(rows[k:k + BATCH])
    z = logits()
    top = worst(z)
    top = top[usable[top]]
    back = top[~learn[doc[top]]]
    if len(set(y[back].tolist())) < 2:
        back = top
    weight = classes[y[back]] / np.maximum(np.bincount(y[back], minlength=2), 1)[y[back]]
    slope, offset = _curve(z[back], y[back], weight * len(back) / weight.sum())
    return Model(emb @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]), slope, offset, share)


def _sample_windows(texts: pa.Array) -> list[list[list[str]]]:
    """Up to TRAIN_WINDOWS windows of each text, evenly spread, as lists of words."""
    n, codes, words, _ = words_of(texts)
    first, words = pretokens.starts(n), [w.encode()[:TRAIN_WORD].decode(errors="ignore") for w in words.to_pylist()]
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        starts = np.arange(a, b, 2 * HALF)
        if len(starts) > TRAIN_WINDOWS:
            starts = starts[np.linspace(0, len(starts) - 1, TRAIN_WINDOWS).astype(int)]
        out.append([[words[c] for c in codes[s:min(b, s + 2 * HALF)]] for s in starts])
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the labelled documents that are not held out."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).filter("text <> ''")
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    marks = marks.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~language.held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    known = common.write_scratch(marks.join(rows.select("id").distinct(), "id").withColumn("h", F.xxhash64("id")), "labelled")
    classes = np.zeros(2)
    for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect():  # two rows at most
        classes[r["y"]] = r["n"]
    known = common.least_hashed(known, "y", PER_CLASS)
    # bounded: PER_CLASS ids of each class
    picked = rows.join(F.broadcast(known.select("id", "y", "h")), "id").groupBy("id", "y", "h").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in pretokens.slices(batch, "text"):
                windows = pa.array(_sample_windows(p.column("text")), pa.list_(pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays([p.column("h"), p.column("y"), windows], ["h", "y", "windows"])

    got = picked.mapInArrow(cut, "h long, y int, windows array<array<string>>").toArrow().sort_by("h")
    return fit(got["windows"].to_pylist(), got["y"].to_numpy().astype(np.int64), classes)


def predict(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` without its text, with score, predicted and peak_word (where the worst window begins, counted in words)."""
    new = {"score": T.DoubleType(), "predicted": T.IntegerType(), "peak_word": T.LongType()}
    keep = [c for c in df.columns if c != text and c not in new]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, t) for c, t in new.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, text):
                score, place = model.scores(part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(place, pa.int64())],
                    [*keep, *new])

    return df.select(*[f"`{c}`" for c in (*keep, text)]).mapInArrow(run, schema)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
