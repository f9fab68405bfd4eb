"""Connected components by alternating star contraction, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.session import cut


#: Links from which on a node's rows are no longer joined by a shuffle on the node.
HOT_LINKS = 1 << 17


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())


def _with_value(rows: DataFrame, values: DataFrame, hot_links: int, most: int) -> DataFrame:
    """rows(a, b), of which there are most at most, joined with values(a, m, n). Nodes of more than hot_links rows (of which there is one in hot_links rows at most) are broadcast,
    so that no task gets all rows of one; with no more rows than that there are none."""
    if most <= hot_links:
        return rows.join(values.select("a", "m"), "a")
    hot = values.where(F.col("n") > hot_links).select("a", F.col("m").alias("hot"))
    marked = rows.join(F.broadcast(hot), "a", "left")
    cool = marked.where("hot is null").select("a", "b").join(values.where(F.col("n") <= hot_links).select("a", "m"), "a").select("a", "b", "m")
    return marked.where("hot is not null").select("a", "b", F.col("hot").alias("m")).unionByName(cool)


def connected_components(links: DataFrame, max_rounds: int = 100, hot_links: int = HOT_LINKS) -> DataFrame:
    """(node, component) of every node in links(a, b), where component is the least node reachable.

    Each round links every node's greater neighbours, then its lesser ones, to its least neighbour
    (two grouped minima, which combine before the shuffle, and two equi-joins); the number of links never grows
    and O(log n) rounds are usual. Each round is cut by a checkpoint in the shared folder. Nulls are no
    links, a node linked to itself is its own component, no links give no rows.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    loops = links.where("a = b").select(F.col("a").alias("node")).distinct()
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _signature(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = _with_value(both, least, hot_links, 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _with_value(large, lower, hot_links, 2 * before[0]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    alone = loops.join(stars.select("node").unionByName(roots.select("node")), "node", "left_anti").select("node", F.col("node").alias("component"))
    return stars.unionByName(roots).unionByName(alone)
