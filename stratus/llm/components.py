"""Connected components of an edge table by alternating large and small stars.

Each round is two grouped minimums and joins on Spark; no component is ever
gathered. A node's edges are reduced map-side before the shuffle, and the join
that hands a node's minimum back to its edges is an ordinary one that adaptive
execution may split at a hot node. Rounds are written to the shared folder, so
a lost executor costs a re-read and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import Rounds


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star: rows (a, b), a > b, every neighbour linked to the smallest one around."""
    both = edges if not large else edges.union(edges.select(F.col("b").alias("a"),
                                                            F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    near = both.join(least, both.a == least.u).drop("u")
    if large:
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the component's least node.

    Nulls and self links are ignored, repeated links counted once; an edge
    table without links gives no rows.
    """
    rounds = Rounds("edges")
    now = rounds.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .where("a <> b").distinct())
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not state[0] or tuple(state) == seen:
            break
        seen = tuple(state)
        now = rounds.write(_star(_star(now, large=True), large=False))
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))
