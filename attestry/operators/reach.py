"""Reachability in the link graph: distances from roots, pages that nothing reaches, cycles.

All of it goes by rounds of joins.  A round joins only its frontier with the edges, and what it finds, less what is known,
is the next one.  Each round's state is a written table, so that plans stay short and a lost executor repeats one round.
A page with very many links is a key of the join like any other: adaptive execution splits it.  The search from roots first
leaves out, once, the edges of nodes that are no roots and that nothing leads to, as no round can come there.  A
frontier of at most ``FEW`` nodes is sent to the edges, which then stay where they are; a larger one meets them by their key.

Null ends of edges lead nowhere and come from nowhere; repeated edges count once; loops of a page to itself are
cycles of one; roots that no edge names are reached all the same; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize


#: Nodes of a frontier that is sent to all tasks at most.
FEW = 100_000


def clean_edges(edges: DataFrame) -> DataFrame:
    """src and dst, each pair once."""
    return edges.select("src", "dst").filter("src is not null and dst is not null").distinct()


def reachable(edges: DataFrame, roots: DataFrame, most: int | None = None) -> DataFrame:
    """node and distance: links from the nearest root (node), 0 for roots, of all nodes within ``most`` links.

    ``edges`` has src and dst.  There are as many rounds as the greatest distance, and one more that finds nothing.
    """
    links = _written(edges)
    return _searched(_walkable(links, _targets(links), roots), roots, most)


def _written(edges: DataFrame) -> DataFrame:
    """src and dst without nulls, as a table; repeated edges stay, as each round counts its nodes once anyway."""
    return materialize(edges.select("src", "dst").filter("src is not null and dst is not null"))


def _targets(links: DataFrame) -> DataFrame:
    """node and linked: what links lead to, and whether any comes from another node."""
    return materialize(links.groupBy(F.col("dst").alias("node")).agg(F.max(F.col("src") != F.col("dst")).alias("linked")))


def _walkable(links: DataFrame, targets: DataFrame, roots: DataFrame) -> DataFrame:
    """The links that a search can come to: those of roots and of nodes that links lead to."""
    heads = targets.select("node").union(roots.select("node"))
    return materialize(links.join(heads, links["src"] == heads["node"], "left_semi").select("src", "dst"))


def _searched(links: DataFrame, roots: DataFrame, most: int | None = None) -> DataFrame:
    frontier = materialize(roots.select("node").filter("node is not null").distinct().withColumn("distance", F.lit(0).cast("long")))
    levels, size = [frontier], frontier.count()
    while most is None or len(levels) <= most:
        known = reduce(DataFrame.union, levels)
        step = links.join(F.broadcast(frontier) if size <= FEW else frontier, links["src"] == frontier["node"], "left_semi").select(F.col("dst").alias("node")).distinct()
        frontier = materialize(step.join(known.select("node"), "node", "left_anti").withColumn("distance", F.lit(len(levels)).cast("long")))
        size = frontier.count()
        if not size:
            break
        levels.append(frontier)
        if len(levels) % 8 == 0:  # one table instead of many
            levels = [*[materialize(reduce(DataFrame.union, levels))], *[frontier.limit(0)] * (len(levels) - 1)]
    return reduce(DataFrame.union, levels)


def orphans(pages: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """node and linked: pages (node) that no root reaches, and whether any link leads to them at all."""
    links = _written(edges)
    targets = _targets(links)
    found = _searched(_walkable(links, targets, roots), roots).select("node")
    left = pages.select("node").filter("node is not null").distinct().join(found, "node", "left_anti")
    return left.join(targets, "node", "left").select("node", F.coalesce("linked", F.lit(False)).alias("linked"))


def trimmed(edges: DataFrame) -> DataFrame:
    """The edges that may lie on a cycle: ends that nothing leads to, or that lead nowhere, go round by round."""
    now = materialize(clean_edges(edges))
    size = now.count()
    while size:
        kept = now.join(now.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(now.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        now = materialize(kept.select("src", "dst"))
        left, size = size, now.count()
        if left == size:
            break
    return now


def _spread(colors: DataFrame, links: DataFrame) -> DataFrame:
    """node and color: the smallest color that leads to each node, its own included."""
    while True:
        passed = colors.join(links, colors["node"] == links["src"]).groupBy(F.col("dst").alias("node")).agg(F.min("color").alias("c"))
        now = materialize(colors.join(passed, "node", "left").select("node", F.least("color", "c").alias("color"), (F.col("c") < F.col("color")).alias("moved")))
        if now.filter("moved").isEmpty():
            return now.select("node", "color")
        colors = now.select("node", "color")


def cycles(edges: DataFrame) -> DataFrame:
    """node, cycle (the smallest node of its strongly connected group) and size, of all nodes on a cycle.

    Each round spreads the smallest node forwards as a color, and then, inside each color, backwards from the node that
    gave it: what both reach is one group.  It goes, what is left is trimmed, and the next round begins.
    """
    links, found = trimmed(edges), []
    while not links.isEmpty():
        nodes = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()
        colors = _spread(nodes.withColumn("color", F.col("node")), links)
        ends = links.join(colors.select(F.col("node").alias("src"), F.col("color").alias("c1")), "src").join(colors.select(F.col("node").alias("dst"), F.col("color").alias("c2")), "dst")
        inside = materialize(ends.filter("c1 = c2").select("src", "dst", "c1"))
        group = materialize(colors.filter("node = color"))
        frontier = group
        while not frontier.isEmpty():
            back = frontier.join(inside, (frontier["node"] == inside["dst"]) & (frontier["color"] == inside["c1"])).select(F.col("src").alias("node"), "color").distinct()
            frontier = materialize(back.join(group, ["node", "color"], "left_anti"))
            group = materialize(group.union(frontier))
        # a group of one is a cycle only with a loop
        sized = group.groupBy("color").agg(F.count("*").alias("size"))
        loops = links.filter("src = dst").select(F.col("src").alias("node"), F.lit(True).alias("loop")).distinct()
        own = group.join(sized, "color").join(loops, "node", "left").filter("size > 1 or loop").select("node", F.col("color").alias("cycle"), "size")
        found.append(materialize(own))
        gone = group.select("node")
        rest = links.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
        links = trimmed(rest.select("src", "dst"))
    if not found:
        node = edges.select(F.col("src").alias("node"))
        return node.select("node", F.col("node").alias("cycle"), F.lit(0).cast("long").alias("size")).limit(0)
    return reduce(DataFrame.union, found)
