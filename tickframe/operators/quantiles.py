"""Exact quantiles that never hold a whole group in one task.

Spark's exact ``percentile`` merges one counter per distinct value of a group
into a single buffer, so one hot group with continuous values lands whole in
one task.  ``exact_percentiles`` instead narrows each target rank down
through rounds of equal-width buckets:

1. per group: count, min, max (partial aggregation);
2. each round: count / min / max per (group, node, bucket) — partially
   aggregated, so the shuffle carries at most ``buckets`` rows per node and
   map task — then, per target rank, keep only the bucket that holds it
   (cumulative counts over that small table);
3. rows outside the kept buckets, and those of a bucket with a single value,
   are dropped; a row belongs to at most one kept bucket, so nothing is
   duplicated.  Nodes of more than ``final_rows`` rows are few and broadcast,
   so no row moves for them;
4. once a kept bucket holds at most ``final_rows`` rows (or a single value),
   rank its rows with a window over that bucket only.

Each round reads only the rows still in play, shrinking by about
``buckets``× per round; the result is the same linear interpolation between
order statistics as ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.session import ensure_checkpoint_dir


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float],
                      buckets: int = 1024, final_rows: int = 200_000) -> DataFrame:
    """One row per group and quantile: ``by…, q, value`` (NaN / NULL ignored)."""
    by = list(by)
    if by and by != ["__group"]:
        # the whole key as one struct, which is never NULL, so groups with NULL keys join like any other
        packed = df.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in by]).alias("__group"), F.col(f"`{value}`").alias("__value"))
        out = exact_percentiles(packed, ["__group"], "__value", qs, buckets, final_rows)
        return out.select("__group.*", "q", F.col("__value").alias(value))
    ensure_checkpoint_dir(df.sparkSession)
    x = df.select(*by, F.col(value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    stats = x.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    # targets: the two order statistics around each quantile position (0-based ranks)
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    tq = stats.select(*by, "__n", F.explode(qarr).alias("q"))
    pos = (F.col("__n") - 1) * F.col("q")
    tq = tq.select(*by, "q", pos.alias("__pos"), F.floor(pos).cast("long").alias("__k0"),
                   F.ceil(pos).cast("long").alias("__k1"))
    ranks = tq.select(*by, F.explode(F.array("__k0", "__k1")).alias("__r")).distinct()

    # node = a value range [lo, hi] holding the target ranks, with `below` rows under it
    nodes = stats.select(*by, F.lit(0).cast("long").alias("__node"), "__lo", "__hi",
                         F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__cnt"))
    rows = x.withColumn("__node", F.lit(0).cast("long"))
    targets = ranks.join(nodes.select(*by, "__node"), by)  # rank → node holding it
    while True:  # a round splits every open node, as its least and largest value differ
        open_nodes = nodes.filter((F.col("__cnt") > final_rows) & (F.col("__hi") > F.col("__lo")))
        if open_nodes.limit(1).count() == 0:
            break
        # at most rows / final_rows nodes: broadcast, as a key of the join below may hold most rows
        open_nodes = F.broadcast(open_nodes)
        # bucket every row of an open node (a row is in one node: no duplication)
        r = rows.join(open_nodes.select(*by, "__node", "__lo", "__hi"), [*by, "__node"])
        width = (F.col("__hi") - F.col("__lo")) / buckets
        # a range too narrow to divide has two values: the least, and what lies above
        b = F.when(width > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / width), F.lit(buckets - 1)).cast("long")).otherwise(
            (F.col("__v") > F.col("__lo")).cast("long"))
        r = r.withColumn("__b", b)
        hist = r.groupBy(*by, "__node", "__b").agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__blo"),
                                                   F.max("__v").alias("__bhi"))
        w = Window.partitionBy(*by, "__node").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        hist = (hist.join(open_nodes.select(*by, "__node", "__below"), [*by, "__node"])
                    .withColumn("__start", F.col("__below") + F.coalesce(F.sum("__c").over(w), F.lit(0))))
        # the bucket holding each target rank of an open node
        hit = (targets.join(hist, [*by, "__node"])
                      .filter((F.col("__r") >= F.col("__start")) & (F.col("__r") < F.col("__start") + F.col("__c"))))
        child = (hit.select(*by, "__node", "__b", "__blo", "__bhi", "__start", "__c").distinct()
                    .withColumn("__child", F.xxhash64("__node", "__b")))
        new_nodes = child.select(*by, F.col("__child").alias("__node"), F.col("__blo").alias("__lo"),
                                 F.col("__bhi").alias("__hi"), F.col("__start").alias("__below"),
                                 F.col("__c").alias("__cnt"))
        closed = nodes.join(open_nodes.select(*by, "__node"), [*by, "__node"], "left_anti")
        # the node and target tables are small: cut their lineage in the shared checkpoint folder
        targets = (targets.join(hit.select(*by, "__r", "__node", "__b"), [*by, "__r", "__node"], "left")
                          .select(*by, "__r", F.when(F.col("__b").isNotNull(), F.xxhash64("__node", "__b"))
                                  .otherwise(F.col("__node")).alias("__node"))).checkpoint(eager=True)
        nodes = closed.unionByName(new_nodes).checkpoint(eager=True)
        kept = child.filter(F.col("__blo") < F.col("__bhi")).select(*by, "__node", "__b", "__child")
        moved = r.join(F.broadcast(kept), [*by, "__node", "__b"]).select(*by, "__v", F.col("__child").alias("__node"))
        stay = rows.join(open_nodes.select(*by, "__node"), [*by, "__node"], "left_anti")
        rows = stay.unionByName(moved).checkpoint(eager=True)

    # resolve each target inside its (small or single-valued) node; large single-valued ones give up their rows here
    full = nodes.filter(F.col("__cnt") > final_rows).select(*by, "__node")
    rows = rows.join(F.broadcast(full), [*by, "__node"], "left_anti")
    t = targets.join(nodes, [*by, "__node"])
    single = t.filter(F.col("__hi") == F.col("__lo")).select(*by, "__r", F.col("__lo").alias("__val"))
    multi_nodes = t.filter(F.col("__hi") > F.col("__lo")).select(*by, "__node").distinct()
    ranked = (rows.join(multi_nodes, [*by, "__node"])
                  .join(nodes.select(*by, "__node", "__below"), [*by, "__node"])
                  .withColumn("__r", F.col("__below") - 1
                              + F.row_number().over(Window.partitionBy(*by, "__node").orderBy("__v"))))
    found = ranked.join(targets, [*by, "__node", "__r"]).select(*by, "__r", F.col("__v").alias("__val"))
    vals = single.unionByName(found)
    v0 = vals.select(*by, F.col("__r").alias("__k0"), F.col("__val").alias("__x0"))
    v1 = vals.select(*by, F.col("__r").alias("__k1"), F.col("__val").alias("__x1"))
    out = tq.join(v0, [*by, "__k0"]).join(v1, [*by, "__k1"])
    frac = F.col("__pos") - F.col("__k0")
    return out.select(*by, "q", F.when(F.col("__k0") == F.col("__k1"), F.col("__x0"))
                      .otherwise((F.col("__k1") - F.col("__pos")) * F.col("__x0") + frac * F.col("__x1")).alias(value))
