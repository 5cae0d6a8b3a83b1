"""ts.knn_novelty: mean Euclidean distance to the k nearest reference vectors.

Exact search as a block join.  A few reference vectors, those with the least
hashes, are *pivots*; rows are dealt into blocks by their nearest pivot and,
where that holds too many, by a hash of the row.  Equal reference vectors are
one with a multiplicity, so blocks follow from the rows' content alone and a
task that runs again deals them the same.

Each block keeps the least and the largest distance of its rows to every pivot.
By the triangle inequality these bound the distances between two blocks from
below and from above: a query block's k nearest lie within the upper bound at
which its nearest blocks hold k vectors, and block pairs whose lower bound is
beyond that are left out without changing any result.  Each pair that stays is
one grouped task that bounds its distances by matrix products, computes those
within the bound directly and keeps the k least of each query.  These lists are merged in stages of ``FAN`` blocks, so no task
holds more than ``FAN * k`` distances of a query.  What passes through the driver
is the pivots and counts.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.session import scratch_path

#: Rows of a block (at least), lists merged at a time, and pivots of a reference set.
BLOCK, FAN, PIVOTS = 4096, 32, 16
#: Blocks of the reference vectors, from which on blocks grow, and how far they grow.
BLOCKS, MOST = 32, 8 * BLOCK
#: Distances held at a time.
SLICE = 1 << 21


def _direct(q: np.ndarray, ref: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Squares and numbers of the ``top`` reference vectors nearest to each query, one query at a time."""
    out = []
    for x in q:
        d = ref - x
        d = np.einsum("ij,ij->i", d, d)
        first = np.argpartition(d, top - 1)[:top]
        first = first[np.argsort(d[first], kind="stable")]
        out.append((d[first], first))
    return out


def _nearest(q: np.ndarray, ref: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same by one matrix product: it bounds the ``top``-th distance from above, and the few vectors
    that may lie within the bound, rounding included, are compared by differences."""
    n, dim = ref.shape
    group = max(1, n // max(2 * top, 64))
    groups = np.arange(0, n, group)
    if not dim or len(groups) < top:
        return _direct(q, ref, top)
    with np.errstate(all="ignore"):
        centre = ref.mean(0)
        r, x = ref - centre, q - centre
        square = np.einsum("ij,ij->i", r, r)
        # the square of a distance, less that of the query
        d = np.hstack([x, np.ones((len(x), 1))]) @ np.hstack([-2 * r, square[:, None]]).T
        slack = 16 * (dim + 8) * np.finfo(float).eps * (np.sqrt(np.einsum("ij,ij->i", x, x)) + np.sqrt(square.max())) ** 2
        # the top-th least of the groups' least
        reach = np.partition(np.minimum.reduceat(d, groups, axis=1), top - 1, axis=1)[:, top - 1] + slack
    if not np.isfinite(d).all() or not np.isfinite(reach).all():
        return _direct(q, ref, top)
    row, col = np.nonzero(d <= reach[:, None])
    if len(row) > 16 * top * len(q):  # many near the bound
        return _direct(q, ref, top)
    diff = ref[col] - q[row]
    exact = np.einsum("ij,ij->i", diff, diff)
    order = np.lexsort((exact, row))
    start = np.searchsorted(row, np.arange(len(q)))
    return [(exact[o], col[o]) for o in (order[s:s + top] for s in start)]


def _least(q: np.ndarray, ref: np.ndarray, many: np.ndarray, k: int) -> list[np.ndarray]:
    """The k least distances of each query, from differences, so that vectors far from the origin lose no digits."""
    top, out = min(k, len(ref)), []
    step = max(1, SLICE // len(ref))
    for start in range(0, len(q), step):
        for d, first in _nearest(q[start:start + step], ref, top):
            out.append(np.sqrt(np.repeat(d, np.minimum(many[first], k))[:k]))
    return out


def _merged(cand: DataFrame, by: list[str | Column], k: int) -> DataFrame:
    return cand.groupBy(*by).agg(F.slice(F.array_sort(F.flatten(F.collect_list("dists"))), 1, k).alias("dists"))


def _dealt(df: DataFrame, name: str, key: str, pivots: np.ndarray, block: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with its block's number, and per block its number, rows and distances to the pivots."""
    def near(batches):
        for t in batches:
            x = np.stack(t["v"].to_numpy()).astype(np.float64) if len(t) else np.zeros((0, pivots.shape[1]))
            d = np.sqrt(((x[:, None, :] - pivots[None]) ** 2).sum(2))
            yield t.assign(cell=d.argmin(1).astype("int32") if len(t) else np.zeros(0, "int32"), far=list(d))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = df.mapInPandas(near, f"{fields}, cell int, far array<double>")
    path = scratch_path(df.sparkSession, f"knn-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    by = [c for c in ("tag", "cell") if c in rows.columns]
    cells = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))  # a row per pivot and set
    rows = rows.join(F.broadcast(cells), by).withColumn("part", F.pmod(F.xxhash64(key), "parts").cast("int")).drop("parts")
    p = range(len(pivots))
    held = F.sum("many") if "many" in df.columns else F.count(F.lit(1))
    size = rows.groupBy(*by, "part").agg(held.alias(f"{name}_rows"),
                                            F.array(*[F.min(F.col("far")[t]) for t in p]).alias(f"{name}_lo"),
                                            F.array(*[F.max(F.col("far")[t]) for t in p]).alias(f"{name}_hi"))
    size = size.withColumn(name, F.row_number().over(Window.orderBy(*by, "part")) - 1)  # a row per block
    return rows, size


def block_pairs(queries: DataFrame, refs: DataFrame, k: int) -> DataFrame:
    """(qb, rb) of the block pairs that can hold one of a query's k nearest; all blocks meet, no rows."""
    both = queries.crossJoin(refs)
    lower = F.array_max(F.zip_with(F.zip_with("qb_lo", "rb_hi", lambda a, b: a - b), F.zip_with("rb_lo", "qb_hi", lambda a, b: a - b),
                                   lambda a, b: F.greatest(a, b, F.lit(0.0))))
    upper = F.array_min(F.zip_with("qb_hi", "rb_hi", lambda a, b: a + b))
    both = both.select("qb", "rb", "tag", "rb_rows", lower.alias("lower"), upper.alias("upper"))
    so_far = Window.partitionBy("qb", "tag").orderBy("upper", "rb").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("seen", F.sum("rb_rows").over(so_far))
    reach = F.min(F.when(F.col("seen") >= k, F.col("upper"))).over(Window.partitionBy("qb", "tag"))
    # a little more than the bound, for the rounding of distances
    return both.withColumn("reach", reach).filter(F.col("reach").isNull() | (F.col("lower") <= F.col("reach") * (1 + 1e-9) + 1e-12)).select("qb", "rb")


def knn_novelty(queries: DataFrame, refs: Mapping[str, DataFrame], id_col: str, vec_col: str, k: int = 4,
                block: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """For every query vector: Σ over reference sets of the mean distance to
    its k nearest vectors in that set (a set with no rows adds 0).

    Rows are sent once per block they meet, so without ``block`` blocks grow with
    the reference vectors, up to ``MOST`` rows."""
    id_type = dict(queries.dtypes)[id_col]
    q = queries.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": left["id"].iloc[:0], "tag": pd.Series([], dtype=object), "rb": pd.Series([], dtype="int32"),
                                 "dists": pd.Series([], dtype=object)})
        x, y = (np.stack(t["v"].to_numpy()).astype(np.float64) for t in (left, right))
        return pd.DataFrame({"id": left["id"], "tag": right["tag"].iloc[0], "rb": int(right["rb_"].iloc[0]), "dists": _least(x, y, right["many"].to_numpy(), k)})

    # all reference sets in one pass, told apart by a tag; equal vectors of a set are one
    every = None
    for tag, ref in refs.items():
        r = ref.select(F.lit(tag).alias("tag"), F.col(vec_col).alias("v"))
        every = r if every is None else every.unionByName(r)
    if every is None:
        return queries.select(id_col, F.lit(0.0).alias("novelty"))
    r = every.groupBy("tag", "v").agg(F.count(F.lit(1)).alias("many"))
    # no more pivots than full blocks: a cell should fill one
    n = r.count()
    block = block or min(MOST, max(BLOCK, math.ceil(n / BLOCKS)))
    pivots = min(pivots, max(1, math.ceil(n / block)))
    first = r.select("v").orderBy(F.xxhash64("v"), "v").limit(pivots).collect()  # bounded: the pivots
    if not first:
        return queries.select(id_col, F.lit(0.0).alias("novelty"))
    centres = np.unique(np.array([x.v for x in first], np.float64), axis=0)
    left, left_blocks = _dealt(q, "qb", "id", centres, block)
    right, right_blocks = _dealt(r, "rb", "v", centres, block)
    pairs = block_pairs(left_blocks, right_blocks, k)
    pairs = pairs.join(left_blocks.select("qb", F.col("cell").alias("qc"), F.col("part").alias("qp")), "qb")
    pairs = pairs.drop("tag").join(right_blocks.select("rb", "tag", F.col("cell").alias("rc"), F.col("part").alias("rp")), "rb")
    left = left.join(pairs.drop("tag"), (F.col("cell") == F.col("qc")) & (F.col("part") == F.col("qp"))).select("id", "v", "qb", "rb")
    right = right.withColumnRenamed("tag", "of").join(
        pairs, (F.col("of") == F.col("tag")) & (F.col("cell") == F.col("rc")) & (F.col("part") == F.col("rp"))).select(
        F.col("of").alias("tag"), "v", "many", F.col("qb").alias("qb_"), F.col("rb").alias("rb_"))  # columns of their own
    cand = left.groupBy("qb", "rb").cogroup(right.groupBy("qb_", "rb_")).applyInPandas(
        compare, f"id {id_type}, tag string, rb int, dists array<double>")
    n_r = right_blocks.count()
    while n_r > FAN:
        cand = _merged(cand, ["id", "tag", F.floor(F.col("rb") / FAN).cast("int").alias("rb")], k)
        n_r = math.ceil(n_r / FAN)
    mean = F.aggregate("dists", F.lit(0.0), lambda a, x: a + x) / F.size("dists")
    score = _merged(cand, ["id", "tag"], k).groupBy(F.col("id").alias(id_col)).agg(F.sum(mean).alias("novelty"))
    return queries.select(id_col).join(score, id_col, "left").fillna({"novelty": 0.0})
