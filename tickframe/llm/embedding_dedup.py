"""Near-duplicate embeddings by cross-polytope hashing.

A table of the index turns unit vectors by three rounds of random signs and a
fast Hadamard transform and takes the axis, with its sign, that a vector is
nearest to; several of these make one code.  A vector lies in the bucket of
its code and also probes the buckets where one axis is its second nearest.
A pair meets where one lies and the other lies or probes; its cosine is then
taken in double precision.  Vectors are compared only within their label (and
dimension).

Equal vectors form a class with one representative and a multiplicity, by a
grouped minimum, so copies are compared once.  The number of axes in a code
grows with the number of distinct vectors, the number of tables with it.  A
bucket of more than ``BLOCK`` members is compared block by block, all of it.
What leaves a comparison is one row per vector: its links there, counted only
in the first place where a pair meets, and the least vector it hangs together
with there.

Null ids, null labels, null or empty vectors, vectors with null or non-finite
components and zero vectors link with nothing.  Equal ids are told apart as
rows: each counts as a vector.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, components

#: Tables of the index for codes of one axis; each further axis doubles them.
TABLES = 6
#: Distinct vectors of a bucket that the length of codes aims at.
PER_BUCKET = 256
#: Members of a bucket compared at a time.
BLOCK = 1024
#: Rows of a task's group of buckets.
GROUP_ROWS = 20_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    x, h = x.copy(), 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), -1)
        h *= 2
    return x


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def codes(x: np.ndarray, tables: int, axes: int, seed: int = 11) -> np.ndarray:
    """(rows, tables, 1 + axes) codes of unit vectors: the own bucket, then the probed ones."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng(seed)
    out = np.zeros((len(x), tables, 1 + axes), np.int64)
    for t in range(tables):
        for a in range(axes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            two = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            value = np.take_along_axis(y, two, 1)
            swap = np.abs(value[:, 1]) > np.abs(value[:, 0])
            two[swap], value[swap] = two[swap][:, ::-1], value[swap][:, ::-1]
            near = two * 2 + (value < 0)
            out[:, t] *= 2 * width
            out[:, t] += near[:, :1]
            out[:, t, 1 + a] += near[:, 1] - near[:, 0]
    return out


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def index_rows(reps: DataFrame, tables: int, axes: int) -> DataFrame:
    """A row for each vector and bucket it lies in or probes; ``codes`` holds all of its codes."""
    fields = [T.StructField("tab", T.IntegerType()), T.StructField("code", T.LongType()), T.StructField("lies", T.BooleanType()),
              T.StructField("codes", T.BinaryType())]
    schema = T.StructType([*reps.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                rows = batch.filter(pa.array(size == d))
                c = codes(unit(rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)), tables, axes)
                n, probes = len(c), tables * (1 + axes)
                many = rows.take(pa.array(np.repeat(np.arange(n), probes)))
                every = pa.array([x.tobytes() for x in c], pa.binary()).take(pa.array(np.repeat(np.arange(n), probes)))
                yield pa.RecordBatch.from_arrays([
                    *many.columns, pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + axes), n)), pa.array(c.ravel()),
                    pa.array(np.tile(np.arange(1 + axes) == 0, n * tables)), every], [*batch.schema.names, "tab", "code", "lies", "codes"])

    return reps.mapInArrow(run, schema)


def _local_roots(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of n vectors the least id it hangs together with by the pairs."""
    root = ids.copy()
    place = np.argsort(ids)
    while True:
        old = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = np.minimum(root, root[place[np.searchsorted(ids, root, sorter=place)]])  # a root's own root
        if (root == old).all():
            return root


def compare_bucket(tab: int, code: int, same: bool, ids, many, unit_vectors, lies, left, right, all_codes, least):
    """(links, roots) of the members of one block of a bucket."""
    x, y = np.flatnonzero(left), np.flatnonzero(right)
    cos = unit_vectors[x] @ unit_vectors[y].T
    p, q = np.nonzero(cos >= least)
    p, q = x[p], y[q]
    # each pair once, and one of the two lies here
    ok = (p < q if same else p != q) & (lies[p] | lies[q])
    p, q = p[ok], q[ok]
    smaller = ids[p] < ids[q]
    s, g = np.where(smaller, p, q), np.where(smaller, q, p)
    own, probed = all_codes[:, :, 0], all_codes
    by_s = (own[s][:, :, None] == probed[g]).any(2)  # g comes to where s lies
    by_g = (own[g][:, :, None] == probed[s]).any(2)
    meets = by_s | by_g
    first = meets.argmax(1) == tab
    here = np.where(by_s[:, tab], own[s, tab], own[g, tab]) == code
    ok = first & here
    s, g = s[ok], g[ok]
    links = np.bincount(s, many[g], len(ids)) + np.bincount(g, many[s], len(ids))
    return links.astype(np.int64), _local_roots(len(ids), s, g, ids)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``df``."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").alias("label"))
    usable = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v")))
    classes = usable.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("many"))
    classes = common.write_scratch(classes, "classes")
    size = classes.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_distinct("label")).first()
    distinct, width, labels = size[0], 2 << max(1, ((size[1] or 2) - 1).bit_length()), max(1, size[2])
    axes = 1
    while distinct / labels / width ** axes > PER_BUCKET and axes < 8:
        axes += 1
    tables = TABLES << (axes - 1)
    spread = index_rows(classes, tables, axes).withColumn("d", F.size("v"))
    cell = ["label", "d", "tab", "code"]
    # vectors that no one shares a bucket with, and those who only probe with others who do, go no further
    sizes = spread.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.max("lies").alias("live")).filter("n > 1 AND live")
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n", "live")
    placed = spread.join(sizes, cell).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    groups = max(common.task_count(df.sparkSession), int(distinct * tables * (1 + axes) // GROUP_ROWS))
    placed = placed.withColumn("grp", F.pmod(F.xxhash64(*cell, "i", "j"), F.lit(groups)).cast("int")).drop("parts", "other")

    def compare(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        col = {c: t.column(c).to_numpy() for c in ("d", "tab", "code", "rep", "many", "own", "i", "j")}
        lab = t.column("label").combine_chunks().dictionary_encode()
        lab = (lab.chunk(0) if isinstance(lab, pa.ChunkedArray) else lab).indices.to_numpy()
        lies = t.column("lies").to_numpy()
        keys = np.stack([lab, col["d"], col["tab"], col["code"], col["i"], col["j"]], 1).astype(np.int64)
        order = np.lexsort(keys.T[::-1])
        edges = np.flatnonzero((np.diff(keys[order], axis=0) != 0).any(1)) + 1
        out = []
        for g in np.split(order, edges):
            d, tab, code, i, j = (int(col[c][g[0]]) for c in ("d", "tab", "code", "i", "j"))
            part = t.take(pa.array(g))
            v = unit(part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(g), d))
            every = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.int64).reshape(len(g), tables, 1 + axes)
            own, ids = col["own"][g], col["rep"][g]
            links, root = compare_bucket(tab, code, i == j, ids, col["many"][g], v, lies[g], own == i, own == j, every, least)
            hit = links > 0
            out.append((ids[hit], links[hit], root[hit]))
        ids, links, roots = (np.concatenate([o[k] for o in out]) for k in range(3))
        return pa.table({"rep": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(roots, pa.int64())})

    found = placed.groupBy("grp").applyInArrow(compare, "rep long, links long, root long")
    found = common.write_scratch(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = components.components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = classes.join(links, "rep", "left").join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    out = rows.withColumn("usable", F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v")))
    linked = out.filter("usable").join(known, ["label", "v"]).select("id", "n_links", "c")
    alone = out.filter("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("c"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", F.col("c").alias("component_id"), (F.col("id") == F.col("c")).alias("kept"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
u AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM e WHERE usable),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
