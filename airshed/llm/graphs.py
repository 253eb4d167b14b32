"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from airshed.session import kept

#: Parts that the links of one node are dealt to.
SALTS = 256


def _both_ways(edges: DataFrame) -> DataFrame:
    """Rows (u, v) for either direction, from one read."""
    ends = F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                            F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    return edges.select(ends)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hook the neighbours of every node onto its smallest neighbour.

    ``large``: larger neighbours of a node move to the smallest of all, the node
    included; otherwise smaller neighbours and the node move to the smallest of them.
    The neighbours of one node are dealt to ``SALTS`` parts; each part has its minimum, and
    the node's is that of at most so many rows.  So no task holds all links of a node.
    """
    near = _both_ways(edges)
    near = near if large else near.filter("v < u")
    near = near.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    smallest = F.min("m").over(Window.partitionBy("u"))
    least = near.groupBy("u", "part").agg(F.min("v").alias("m")).select("u", "part", smallest.alias("m"))
    if large:
        least = least.select("u", "part", F.least("u", "m").alias("m"))
        near = near.filter("v > u")
    moved = near.join(least, ["u", "part"]).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, component) for every node with a link: the smallest node reachable.

    ``edges`` has two long columns ``a`` and ``b``; direction, repeats and loops do not
    matter.  Large and small stars alternate until nothing changes, which takes a
    number of rounds in the order of the logarithm of the largest component; each round
    is written to the shared folder, so lost executors cost one round at most.
    """
    edges = kept(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), label)
    before = _summary(edges)
    while before[0]:
        edges = kept(_star(_star(edges, True), False), label)
        after = _summary(edges)
        if after == before:
            break
        before = after
    # Stars: every edge leads from a node to its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
