"""Connected components of a graph given by its links, as joins and aggregates.

Alternating large-star and small-star steps: each node hands its larger (or
smaller) neighbours to the least of them.  A step is one grouped minimum,
combined before the shuffle, and one join whose hot keys adaptive execution
splits; a node's neighbours are never gathered.  The links are written to the
shared folder after each round, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _hand_over(links: DataFrame, larger: bool) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.filter("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node that a link (a, b) names; component is the least id reachable."""
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = common.write_scratch(links, "links")
    state = _state(links)
    while state[0]:
        old, links = links, common.write_scratch(_hand_over(_hand_over(links, True), False), "links")
        common.drop_scratch(old)
        new = _state(links)
        if new == state:
            break
        state = new
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
