"""Hard-negative mining by rotated one-bit codes with a sure interval.

A vector is turned at random and each turned component's sign is a bit of its
code.  The code stands for a unit vector; the vector's length along it (its
alignment) is stored, and what the code leaves over is coded again under the
next rotation.  An anchor's turned components are rounded to a few bits and cut
into planes, so that counting the bits of (code AND plane) estimates the inner
product of the anchor with every code vector of a row.  How far the estimate
can be off is known: the anchor's rounding, and, by Cauchy-Schwarz, the row's
remaining length times the anchor's length off the last code vector.  This
interval holds for certain, so a row whose interval cannot reach an anchor's
first ones is left out without changing any result, and the rows that survive
are scored in whole numbers.

An anchor's positives are its best rows of the same label; its negatives, for
each positive, the best rows of other labels whose score lies in a window given
by the positive's score.  Components count as floor(scale * x).  Equal scores
are ordered by the smaller id.

Rows and anchors meet block by block (blocks of bounded size, dealt by a hash
of the id), so a label that holds most rows is spread like any other; a block
emits only its own first ones for each anchor, and a window ranks those.

Rows with a null id, a null label, a null vector or a null or non-finite
component (after scaling) take no part.  Of rows that share an id the one with
the least label, then vector, takes part.  Vectors are compared only with
vectors of the same length; empty ones score 0.  Anchors without positives or
without negatives have no rows.  Scores beyond the range of a long are held at
its ends.  Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .embedding_dedup import hadamard

#: One-bit codes of a vector, each of what the ones before leave over.
ROTATIONS = 3
#: Bits of an anchor's turned components.
PLANES = 6
#: Rows and anchors that meet in one group at most, about.
ROW_BLOCK, ANCHOR_BLOCK = 32_768, 8_192
#: Estimates held at a time.
CELLS = 1 << 20
#: Groups up to which their sizes are sent to all tasks (24 bytes each and the label).
SMALL = 100_000
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
LEAST, MOST = 30, 90


def quantised(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x.astype(np.float64))


def _width(d: int) -> int:
    return 1 << max(0, d - 1).bit_length()


def _signs(width: int, rotation: int) -> np.ndarray:
    return np.random.default_rng([width, rotation]).choice([-1.0, 1.0], (3, width))


def turn(x: np.ndarray, rotation: int, back: bool = False) -> np.ndarray:
    """Random rotation of each row (its width a power of two): three rounds of signs and Hadamard transforms."""
    signs, root = _signs(x.shape[1], rotation), np.sqrt(x.shape[1])
    for s in signs[::-1] if back else signs:
        x = hadamard(x) * s / root if back else hadamard(x * s) / root
    return x


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits of the last axis as words of 64."""
    short = -bits.shape[-1] % 64
    bits = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, short)])
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def _padded(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, _width(x.shape[1]) - x.shape[1])))


@dataclass
class Codes:
    """Of n rows: bits (n, rotations, words), alignments (n, rotations) and the length left over (n)."""
    bits: np.ndarray
    along: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Codes:
        left = _padded(x)
        width, bits, along = left.shape[1], [], []
        for r in range(ROTATIONS):
            y = turn(left, r)
            up = y >= 0
            length = np.abs(y).sum(1) / np.sqrt(width)
            left = left - turn(np.where(up, 1.0, -1.0) / np.sqrt(width), r, back=True) * length[:, None]
            bits.append(_packed(up))
            along.append(length)
        return cls(np.stack(bits, 1), np.stack(along, 1), np.sqrt((left * left).sum(1)))


class Anchors:
    """Of m anchors: rounded turned components as bit planes, the rounding's reach, and lengths."""

    def __init__(self, q: np.ndarray):
        q = _padded(q)
        self.width, self.length = q.shape[1], np.sqrt((q * q).sum(1))
        self.low, self.step, self.total, self.planes, self.reach = [], [], [], [], []
        for r in range(ROTATIONS):
            y = turn(q, r)
            low = y.min(1, keepdims=True)
            step = np.maximum(y.max(1, keepdims=True) - low, 1e-300) / ((1 << PLANES) - 1)
            u = np.rint((y - low) / step).astype(np.int64)
            self.low.append(low)
            self.step.append(step)
            self.total.append(u.sum(1, keepdims=True))
            self.planes.append(_packed((u[:, None, :] >> np.arange(PLANES)[:, None]) & 1 == 1))
            self.reach.append(np.abs(y - (low + step * u)).sum(1, keepdims=True) / np.sqrt(self.width))

    def interval(self, part: slice, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the inner products of some anchors with all rows."""
        estimate, off, last = 0.0, 0.0, 0.0
        for r in range(ROTATIONS):
            bits = codes.bits[:, r]
            ones = np.bitwise_count(bits).sum(1, dtype=np.int64)
            shared = np.zeros((self.planes[r][part].shape[0], len(bits)))
            for j in range(PLANES):
                for w in range(bits.shape[1]):
                    shared += np.float64(1 << j) * np.bitwise_count(self.planes[r][part, j, w, None] & bits[:, w])
            product = (self.low[r][part] * (2 * ones - self.width) + self.step[r][part] * (2 * shared - self.total[r][part])) / np.sqrt(self.width)
            estimate = estimate + product * codes.along[:, r]
            off = off + self.reach[r][part] * codes.along[:, r]
            last = np.maximum(np.abs(product) - self.reach[r][part], 0)
        length = self.length[part, None]
        off = off + codes.rest * np.sqrt(np.maximum(length * length - last * last, 0))
        # rounding of the doubles themselves
        off = off + 1e-9 * length * (codes.rest + codes.along.sum(1)) + 1e-6
        return estimate - off, estimate + off


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of one anchor with rows of whole numbers."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, len(q))
    if top < 2.0 ** 53:
        return (x @ q).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = [sum(a * b for a, b in zip(row, whole(q), strict=True)) for row in whole(x)]
    return np.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for s in exact], np.int64)


def _kth(x: np.ndarray, k: int) -> float:
    """The k-th largest, or minus infinity."""
    return -np.partition(-x, k - 1)[k - 1] if len(x) >= k else -np.inf


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _matrix(col: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = col.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n and len(flat) else np.zeros((n, 0))


class Block:
    """A block of rows as a task gets it."""

    def __init__(self, rows: pa.Table):
        n = rows.num_rows
        self.ids = rows["id"].to_numpy()
        self.x = quantised(_matrix(rows["v"], n))
        self.labels = np.array(rows["label"].to_pylist(), object)
        self.codes = Codes(np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint64).reshape(n, ROTATIONS, -1),
                           _matrix(rows["along"], n), rows["rest"].to_numpy())

    def tiles(self, q: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, lower, upper) for each anchor, a tile of them estimated at a time."""
        anchors, step = Anchors(q), max(1, CELLS // max(1, len(self.ids)))
        for k in range(0, len(q), step):
            lower, upper = anchors.interval(slice(k, k + step), self.codes)
            yield from zip(range(k, k + len(lower)), np.nan_to_num(lower, nan=-np.inf), upper, strict=True)


def _positives(rows: pa.Table, anchors: pa.Table, keep: int) -> pa.Table:
    """The first rows of a block for each anchor; all are of its label."""
    block, out = Block(rows), []
    q = quantised(_matrix(anchors["v"], anchors.num_rows))
    names = anchors["id"].to_numpy()
    for k, lower, upper in block.tiles(q):
        other = block.ids != names[k]
        live = np.flatnonzero(other & ~(upper < _kth(lower[other], keep)))
        s = scores(q[k], block.x[live])
        first = _first(s, block.ids[live], keep)
        out.append((np.repeat(names[k], len(first)), block.ids[live][first], s[first]))
    return _table(out, ("anchor_id", "positive_id", "positive_score"))


def _negatives(rows: pa.Table, anchors: pa.Table, keep: int, least: int, most: int) -> pa.Table:
    """The first rows of a block of another label in the window of each of an anchor's positives."""
    block, out = Block(rows), []
    q = quantised(_matrix(anchors["v"], anchors.num_rows))
    names, labels, positives = anchors["id"].to_numpy(), anchors["label"].to_pylist(), anchors["positives"].to_pylist()
    for k, lower, upper in block.tiles(q):
        other = np.flatnonzero(block.labels != labels[k])
        low, high = lower[other], upper[other]
        windows = [(p["positive_id"], p["positive_score"], -(-least * p["positive_score"] // 100), most * p["positive_score"] // 100)
                   for p in positives[k]]
        windows = [w for w in windows if w[2] <= w[3]]
        live = np.zeros(len(other), bool)
        for _, _, a, b in windows:
            sure = low[(low >= a) & (high <= b)]
            live |= ~(high < max(a, _kth(sure, keep))) & ~(low > b)
        cand = other[live]
        s, ids = scores(q[k], block.x[cand]), block.ids[cand]
        for p, ps, a, b in windows:
            inside = np.flatnonzero((s >= a) & (s <= b))
            first = inside[_first(s[inside], ids[inside], keep)]
            n = len(first)
            out.append((np.repeat(names[k], n), np.repeat(p, n), np.repeat(ps, n), ids[first], s[first]))
    return _table(out, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))


def _table(parts: list[tuple], names: tuple[str, ...]) -> pa.Table:
    cols = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(names))]
    return pa.table([pa.array(c.astype(np.int64), pa.int64()) for c in cols], list(names))


def index(df: DataFrame, id_col: str, vector: str, label: Column) -> DataFrame:
    """(id, label, v, d, bits, along, rest) of every row that takes part."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("string").alias("label"), v.alias("v"), finite.alias("ok"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND ok").groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    rows = rows.select("id", "r.label", "r.v", F.size("r.v").alias("d"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column("d").to_numpy()
            for size in np.unique(d):
                part = batch.filter(pa.array(d == size))
                n = part.num_rows
                codes = Codes.of(quantised(_matrix(pa.chunked_array([part.column("v")]), n)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([b.tobytes() for b in codes.bits], pa.binary()), pa.array(list(codes.along), pa.list_(pa.float64())),
                     pa.array(codes.rest)], [*part.schema.names, "bits", "along", "rest"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, bits binary, along array<double>, rest double")


def _meet(rows: DataFrame, anchors: DataFrame, keys: list[str]):
    """Rows and anchors of equal ``keys`` as a grid of blocks, ready to be compared."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    sizes = common.write_scratch(sizes.join(anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")), keys), "sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= SMALL else sizes
    # small tables are cut finer, to keep all cores busy
    spread = 2 * rows.sparkSession.sparkContext.defaultParallelism
    down = F.greatest(F.ceil(F.col("n") / ROW_BLOCK), F.least(F.ceil(F.col("n") / 1024), F.lit(spread))).cast("int")
    across = F.ceil(F.col("m") / ANCHOR_BLOCK).cast("int")

    def place(df: DataFrame, own: str, parts: Column, other: str, copies: Column) -> DataFrame:
        df = df.join(sizes, keys).withColumn(own, F.pmod(F.xxhash64("id"), parts).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), copies - 1))).drop("n", "m")

    cell = [*keys, "down", "across"]
    return place(rows, "down", down, "across", across).groupBy(*cell).cogroup(place(anchors, "across", across, "down", down).groupBy(*cell))


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: Column | None = None,
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on ``id``."""
    rows = common.write_scratch(index(df, id_col, vector, F.col("`label`") if label is None else label), "codes")
    anchors = rows.filter(is_anchor).select(*[F.col(c).alias(c) for c in ("id", "label", "d", "v")])  # columns of their own

    def first_positives(r: pa.Table, a: pa.Table) -> pa.Table:
        return _positives(r, a, positives)

    def first_negatives(r: pa.Table, a: pa.Table) -> pa.Table:
        return _negatives(r, a, negatives, least, most)

    found = _meet(rows, anchors, ["d", "label"]).applyInArrow(first_positives, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    # at most ``positives`` rows of an anchor
    found = found.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    anchors = common.write_scratch(anchors.join(found.withColumnRenamed("anchor_id", "id"), "id"), "anchors")
    out = _meet(rows, anchors, ["d"]).applyInArrow(
        first_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    out = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, label=label)


SQL = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND {LEAST} * p.score <= 100 * s.score AND 100 * s.score <= {MOST} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
