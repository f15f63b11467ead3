"""Connected components of a links table, by hooking and pointer jumping.

Each round joins the links with the current roots of both ends, hangs every
root that meets a smaller one below the smallest it meets, and lets all nodes
jump to their root's root.  Links inside one tree drop out.  The joins have one row per node on
one side, so that adaptive execution can split a node with very many links.
Nothing but row counts reaches the driver; each round is a kept table, so a
lost executor costs a file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.corpus import Shelf


def components(links: DataFrame, shelf: Shelf, name: str = "component") -> DataFrame:
    """``node, component``: for every node of a link (``a``, ``b``) the smallest node it reaches.

    Links may repeat, run both ways or meet themselves; NULL ends are ignored.
    """
    open_links = shelf.keep(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links-0")
    # the first hook needs no join: every node's smallest neighbour or itself
    ends = open_links.select("a", "b").union(open_links.select(F.col("b").alias("a"), F.col("b")))
    tree = shelf.keep(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), f"{name}-tree-0")
    turn = 0
    while True:
        turn += 1
        tree = _jump(tree, shelf, f"{name}-tree-{turn}")
        of_a = tree.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        of_b = tree.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        met = (open_links.join(of_a, "a").join(of_b, "b").where("root_a != root_b")
               .select(F.greatest("root_a", "root_b").alias("a"), F.least("root_a", "root_b").alias("b")).distinct())
        open_links = shelf.keep(met, f"{name}-links-{turn}")
        if open_links.isEmpty():
            return tree.select("node", F.col("root").alias("component"))
        # from here on links join roots, and only roots move
        hooks = open_links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("lower"))
        tree = shelf.keep(tree.join(hooks, "node", "left").select("node", F.coalesce("lower", "root").alias("root")),
                          f"{name}-hooked-{turn}")


def _jump(tree: DataFrame, shelf: Shelf, name: str) -> DataFrame:
    """Replace roots by their roots until no node moves."""
    turn = 0
    while True:
        upper = tree.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        step = shelf.keep(tree.join(upper, "root").select("node", F.col("upper").alias("root"),
                                                          (F.col("upper") != F.col("root")).alias("moved")),
                          f"{name}-{turn}")
        turn += 1
        tree = step.select("node", "root")
        if step.where("moved").isEmpty():
            return tree
