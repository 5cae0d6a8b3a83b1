"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct word shingles.  A register holds the
truncated logarithm, to a base close to 1, of the least of exponentially
distributed hashes of the set: registers merge by maximum, and two sets agree
in a register about as often as they share elements.  Bands of registers give
buckets; a pair from a bucket is judged by the joint likelihood of its two
sketches, and what passes is confirmed on the full sets.

1. Documents with equal sets form a class with one representative, by a
   grouped minimum; copies go no further.
2. In each bucket all members are compared with its centre only, the member
   whose buckets are the most crowded, and the links confirmed are joined
   into components.
3. Buckets whose members are still in several components are compared across
   components: members of the bucket's largest component against the others,
   and these among themselves, in blocks of bounded size.  Pairs inside a
   component need no comparison, as they can change nothing.

Pairs are judged where a block of a bucket is; only links that join two
components leave it.  The likelihood test drops a pair only where the registers contradict the wanted similarity (see
``LEAST_EVIDENCE``).

Null and wordless texts have empty sets and link with nothing; fewer words
than a shingle are one shingle.  Repeated rows of an id are one document for
linking and stay repeated in the result.  Ties cannot arise: the component is
the least id.  Null ids get a null component.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, components, pretokens, wordhash

REGISTERS, ROWS = 80, 4
BANDS = REGISTERS // ROWS
#: Register base and rate of the exponential hashes.
BASE, RATE = 1.01, 20.0
#: Log-likelihood by which the best similarity must beat the wanted one before a pair is dropped: about 1 in 10^6 of true links.
LEAST_EVIDENCE = 12.0
#: Equal registers below which a pair is dropped before its likelihood is taken: half of them, which
#: true links of 0.8 miss with a chance of about 2 in 10^8 (Chernoff bound), of 0.85 far less.
LEAST_EQUAL = REGISTERS // 2
#: Members of a bucket compared at a time.
BLOCK = 1024
#: Sets a task keeps at hand; what falls out is made again.
KEPT_SETS = 4096
#: Rows of a task's group of buckets, and pairs it looks at in one step.
GROUP_ROWS, PAIRS = 20_000, 1 << 17
#: Text bytes per step in a task.
SLICE = 2 << 20

_rng = np.random.default_rng(7)
_FACTOR = _rng.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; ASCII case is ignored."""
    w = wordhash.words(texts, lower=True)
    all_runs = wordhash.runs(w.hash, k) if len(w.hash) >= k else w.hash[:0]
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= k:
            yield np.unique(all_runs[a:b - k + 1])
        else:  # the whole sequence as one shingle, apart from those of k words
            yield wordhash.runs(w.hash[a:b], b - a) ^ np.uint64(b - a) if b > a else w.hash[:0]


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        low = np.minimum(low, (s[at:at + 4096, None] * _FACTOR + _ADD).min(0))
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535).astype(np.uint16)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, f1, f2, regs): set size, an order-free 128-bit fingerprint of the set, registers."""
    schema = T.StructType([docs.schema["id"], T.StructField("n", T.LongType()), T.StructField("f1", T.LongType()),
                           T.StructField("f2", T.LongType()), T.StructField("regs", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, "text", SLICE):
                n, f1, f2, regs = [], [], [], []
                for s in shingle_sets(part.column("text"), k):
                    n.append(len(s))
                    f1.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                    f2.append(int(wordhash.mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64).astype(np.int64)))
                    regs.append(registers(s).tobytes() if len(s) else b"")
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                                                  pa.array(f2, pa.int64()), pa.array(regs, pa.binary())], ["id", "n", "f1", "f2", "regs"])

    return docs.mapInArrow(run, schema)


def may_reach(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sketches can belong to sets of at least that similarity.

    The joint log-likelihood of a similarity j, with u and v the shares of the
    two sizes, is  D+ log p(u - v j) + D- log p(v - u j) + D0 log(1 - both),
    where D count the registers that are larger, smaller and equal and
    p(x) = -log_b(1 - x (b - 1) / b).
    """
    wanted = percent / 100
    u = n_left / (n_left + n_right)
    v = 1 - u
    more, less = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - more - less

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        p = [-np.log1p(-np.maximum(x, 1e-9) * (BASE - 1) / BASE) / np.log(BASE) for x in (u - v * j, v - u * j)]
        return more * np.log(p[0]) + less * np.log(p[1]) + same * np.log(np.maximum(1 - p[0] - p[1], 1e-9))

    most = np.minimum(u / v, v / u)  # similarity that the sizes allow
    grid = np.stack([log_likelihood(np.minimum(most, f)) for f in np.linspace(0, 1, 21)])
    best_at_least = np.stack([log_likelihood(np.clip(f, wanted, np.maximum(most, wanted))) for f in np.linspace(wanted, 1, 6)]).max(0)
    return (100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)) & (grid.max(0) - best_at_least <= LEAST_EVIDENCE)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


def band_keys(reps: DataFrame) -> DataFrame:
    """(key, band) of each representative: a 64-bit hash of each band's registers."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.substring("regs", b * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("key")))
    return reps.select("id", F.inline(bands))


def packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, packed): the compressed texts of the documents named, as a table."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = zstandard.ZstdCompressor(level=6)
            col = batch.column("text").cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([z.compress(x.as_py() or b"") for x in col], pa.binary())],
                                             ["id", "packed"])

    schema = T.StructType([docs.schema["id"], T.StructField("packed", T.BinaryType())])
    return common.write_scratch(docs.mapInArrow(squeeze, schema).join(ids.distinct(), "id", "left_semi").dropDuplicates(["id"]), "texts")


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * shared >= percent * united, as a table.

    ``pairs`` is a scratch table and goes.
    """
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("packed").alias("pa")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("packed").alias("pb")), "b")
    out = T.StructType([T.StructField("a", pairs.schema["a"].dataType), T.StructField("b", pairs.schema["b"].dataType)])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, hub, hub_set = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                b = batch.column("b")[i].as_py()
                if b != hub:
                    hub, (hub_set,) = b, shingle_sets(pa.array([z.decompress(batch.column("pb")[i].as_py())], pa.binary()), k)
                mine, = shingle_sets(pa.array([z.decompress(batch.column("pa")[i].as_py())], pa.binary()), k)
                shared = len(np.intersect1d(mine, hub_set, assume_unique=True))
                keep.append(100 * shared >= percent * (len(mine) + len(hub_set) - shared) and shared > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = common.write_scratch(both.select("a", "b", "pa", "pb").mapInArrow(confirm, out), "links")
    common.drop_scratch(pairs)
    return links


def centres(buckets: DataFrame) -> DataFrame:
    """(band, key, centre): the member of each bucket whose buckets are the most
    crowded in sum, the least id of several.  Of a group of copies that text
    is nearest to all."""
    sizes = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"))
    crowd = buckets.join(sizes, ["band", "key"]).groupBy("id").agg(F.sum("size").alias("crowd"))
    hubs = buckets.join(crowd, "id").groupBy("band", "key").agg(F.max(F.struct("crowd", (-F.col("id")).alias("neg"))).alias("m"))
    return hubs.select("band", "key", (-F.col("m.neg")).alias("centre"))


def to_centre(buckets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of a member and the centre of its bucket that the sketches allow."""
    pairs = buckets.filter("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    regs = reps.select("id", "n", "regs")
    pairs = pairs.join(regs.toDF("a", "na", "ra"), "a").join(regs.toDF("b", "nb", "rb"), "b")
    schema = T.StructType([T.StructField("a", reps.schema["id"].dataType), T.StructField("b", reps.schema["id"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = may_reach(_matrix(batch.column("ra").to_pylist()), _matrix(batch.column("rb").to_pylist()),
                               batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, schema)


def across(buckets: DataFrame, reps: DataFrame, labels: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Links (a, b) between components that meet in a bucket, confirmed on full
    sets, enough of them to join all that hang together; None if there are none.

    All pairs of a bucket and different components but those with the centre
    are judged; a pair whose components a link has joined meanwhile is not.
    """
    named = buckets.filter("id <> centre").join(labels, "id", "left").select(
        "band", "key", "id", F.coalesce("component", "id").alias("label"))
    sizes = named.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"),
                                             F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    rest = F.col("size") - F.col("top.n")
    mixed = common.write_scratch(mixed.select(
        "band", "key", F.col("top.label").alias("top"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("tops"),
        F.ceil(rest / BLOCK).cast("int").alias("rests"), F.col("top.n").alias("n_top"), rest.alias("n_rest")), "mixed")
    cells_rows = mixed.agg(F.sum(F.expr("n_top * rests + n_rest * (tops + rests)"))).first()[0]
    if not cells_rows:
        return None
    rows = named.join(mixed, ["band", "key"]).withColumn("is_top", F.col("label") == F.col("top"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("rests"))).cast("int")
    rows = rows.withColumn("own", own)
    # A cell compares one block of others (j) with a block of the largest component (i) or with a block of others.
    every = lambda n: F.sequence(F.lit(0), n - 1)
    with_top = F.transform(every(F.when(F.col("is_top"), F.col("rests")).otherwise(F.col("tops"))), lambda x: F.struct(
        F.lit(0).alias("kind"), F.when(F.col("is_top"), x).otherwise(F.col("own")).alias("j"),
        F.when(F.col("is_top"), F.col("own")).otherwise(x).alias("i")))
    with_rest = F.transform(every(F.col("rests")), lambda x: F.struct(
        F.lit(1).alias("kind"), F.least(x, F.col("own")).alias("j"), F.greatest(x, F.col("own")).alias("i")))
    cells = rows.select("band", "key", "id", "label", "own", "is_top", F.explode(
        F.when(F.col("is_top"), with_top).otherwise(F.concat(with_top, with_rest))).alias("cell"))
    cells = cells.select("band", "key", "cell.*", "id", "label", "own", "is_top").join(reps.select("id", "n", "regs"), "id")
    cells = cells.join(texts, "id")
    # many small cells share a task's group; a cell is in one group
    groups = max(common.task_count(reps.sparkSession), int(cells_rows // GROUP_ROWS))
    cells = cells.withColumn("grp", F.pmod(F.xxhash64("band", "key", "kind", "j", "i"), F.lit(groups)).cast("int"))

    def compare(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("band", "key", "kind", "j", "i", "id", "label", "own", "is_top", "n")}
        order = np.lexsort([col[c] for c in ("i", "j", "kind", "key", "band")])
        col = {c: v[order] for c, v in col.items()}
        regs = _matrix(table.column("regs").to_pylist())[order]
        edge = np.ones(len(order), bool)
        edge[1:] = np.logical_or.reduce([col[c][1:] != col[c][:-1] for c in ("i", "j", "kind", "key", "band")])
        heads = np.flatnonzero(edge)
        ends = np.repeat(np.append(heads[1:], len(order)), np.diff(np.append(heads, len(order))))
        partners = ends - np.arange(len(order)) - 1  # rows of the same cell that follow
        upto, found, at = pretokens.starts(partners), [], 0
        z, packed, sets, root = zstandard.ZstdDecompressor(), table.column("packed"), {}, {}

        def set_of(row: int) -> np.ndarray:
            i = col["id"][row]
            if i not in sets:
                if len(sets) > KEPT_SETS:
                    sets.clear()
                sets[i], = shingle_sets(pa.array([z.decompress(packed[int(order[row])].as_py())], pa.binary()), k)
            return sets[i]

        def component(row: int) -> int:
            c = col["label"][row]
            while root.get(c, c) != c:
                c = root[c]
            return c

        def confirm(x: list[int], y: list[int]) -> None:
            for p, q in zip(x, y, strict=True):
                c, d = component(p), component(q)
                if c != d:
                    left, right = set_of(p), set_of(q)
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    if 100 * shared >= percent * (len(left) + len(right) - shared):
                        root[max(c, d)] = min(c, d)
                        found.append((int(col["id"][p]), int(col["id"][q])))

        while at < len(order):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, side="right")) - 1)
            x = np.repeat(np.arange(at, to), partners[at:to])
            y = x + 1 + np.arange(len(x)) - (upto[x] - upto[at])
            role = np.where(col["kind"][x] == 0, col["is_top"][x] != col["is_top"][y],
                            (col["i"][x] == col["j"][x]) | (col["own"][x] != col["own"][y]))
            small, large = np.minimum(col["n"][x], col["n"][y]), np.maximum(col["n"][x], col["n"][y])
            ok = role & (col["label"][x] != col["label"][y]) & (100 * small >= percent * large)
            x, y = x[ok], y[ok]
            equal = regs[x] == regs[y]
            # a pair is judged in the first bucket that it shares
            ok = (equal.sum(1) >= LEAST_EQUAL) & (equal.reshape(-1, BANDS, ROWS).all(2).argmax(1) == col["band"][x])
            x, y = x[ok], y[ok]
            if len(x):
                ok = may_reach(regs[x], regs[y], col["n"][x], col["n"][y], percent)
                confirm(x[ok].tolist(), y[ok].tolist())
            at = to
        return pa.table({"a": pa.array([max(f) for f in found], pa.int64()), "b": pa.array([min(f) for f in found], pa.int64())})

    links = common.write_scratch(cells.groupBy("grp").applyInArrow(compare, "a long, b long").distinct(), "links")
    common.drop_scratch(mixed)
    return links


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``df``."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    sk = common.write_scratch(sketches(docs, shingle), "sketches")
    classes = sk.filter("n > 0 AND id IS NOT NULL").groupBy("n", "f1", "f2").agg(F.min(F.struct("id", "regs")).alias("m"))
    reps = common.write_scratch(classes.select("n", "f1", "f2", "m.id", "m.regs"), "classes")
    every = common.write_scratch(band_keys(reps), "buckets")
    crowded = every.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("band", "key")
    buckets = every.join(crowded, ["band", "key"], "left_semi")
    buckets = common.write_scratch(buckets.join(centres(buckets), ["band", "key"]), "crowded")
    common.drop_scratch(every)
    # texts travel once, and only those of documents that share a bucket
    texts = packed_texts(docs.filter("id IS NOT NULL"), buckets.select("id"))
    links = verify(common.write_scratch(to_centre(buckets, reps, percent), "pairs"), texts, shingle, percent)
    labels = components.components(links)
    more = across(buckets, reps, labels, texts, shingle, percent)
    common.drop_scratch(texts)
    if more is not None:
        labels = components.components(more.union(labels.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    least = reps.join(labels, "id", "left").select("n", "f1", "f2", F.coalesce("component", "id").alias("component"))
    out = sk.select("id", "n", "f1", "f2").join(least, ["n", "f1", "f2"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")).withColumn("kept", F.col(f"`{id_col}`") == F.col("component_id"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir), shingle=3, percent=85)


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM w JOIN c ON c.a = doc_id LEFT JOIN n USING (doc_id)
"""
