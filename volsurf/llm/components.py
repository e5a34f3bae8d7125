"""Connected components of a link table by alternating star contraction.

Every round is a few hash aggregations and equi-joins; of nodes and
links nothing reaches the driver but whether the rounds are over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

MAX_ROUNDS = 200


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up")), F.struct(F.col("v").alias("n"), F.lit(0).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.n").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("low"))
    return nodes.filter("ups > 1 or (ups = 1 and low = 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` with long ids, in any direction, loops and repeats allowed.

    Returns ``(node, root)`` for every node that has a smaller node in its
    component; ``root`` is the smallest.  Nodes absent from the result are their
    own root.  Links with a null end are ignored; no links give an empty result.

    A round hangs each node's larger neighbours, then its smaller ones, on the
    smallest neighbour.  The minima are materialized, so that the join that
    follows has two plain exchanges below it and adaptive execution can split
    the links of one very popular node.
    """
    cur = materialize(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if _settled(cur):
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = materialize(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low2 = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        hung = F.col("v") != F.col("m")
        small = large.join(low2, "u").select(F.when(hung, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        nxt = materialize(small.filter("u != v").distinct(), "links")
        for t in (cur, low, large, low2):
            discard(t)
        cur = nxt
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
