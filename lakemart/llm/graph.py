"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import discard, stage


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger end ``a`` to its smaller end ``b``."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                        F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of a node hang on the smallest of them and itself.

    large: from neighbours that are larger than the node; small: from those that are not.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
        if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if large:
        return _directed(hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
    return _directed(hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that is reachable, for every node of an edge.

    ``edges`` has long columns a and b, in any direction, repeats and loops
    allowed; nodes with loops alone are left out, as are null ends.  Large and
    small stars alternate until nothing changes, each round a written table: the
    number of rounds grows with the logarithm of the longest path, and a hub with
    many neighbours is never gathered, only its minimum.
    """
    edges = stage(_directed(edges.where("a is not null and b is not null")), name)
    state = None
    while True:
        before, edges = edges, stage(_star(_star(edges, large=True), large=False), name)
        discard(before)
        # a star forest: every node hangs on one smaller node that hangs on none
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                                                 F.lit(0))).first()
        if now == state or now[0] == 0:
            break
        state = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")))
            .distinct())
