"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star rounds: every round replaces each node's
links by links to the smallest label around it, until nothing changes. Rounds
grow with the logarithm of the longest chain. Each half-round is a map-side
combined minimum and one join; both sides are written tables, so adaptive
execution may split a hub's rows, and no links reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeshore.llm.store import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else both.where("v < u")
    lowest = seen.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    lowest = written(lowest, "star-min")
    rows = (both.where("v > u") if large else both.where("v < u")).join(lowest, "u")
    out = rows.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:  # the node itself also hangs on its minimum
        out = out.unionByName(lowest.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u long, v long) -> (node long, root long) for every node with a
    link to another; root is the smallest node reachable. Loops and repeated
    links are allowed; an empty table gives an empty table; null ends are left
    out."""
    links = written(links.select("u", "v").where("u != v").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = written(_star(links, large=True), "star")
        links = written(_star(links, large=False), "star")
        now = _state(links)
        if now == state:
            break
        state = now
    pairs = links.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    found = pairs.groupBy("node").agg(F.min("root").alias("root"))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots)


def forest(a, b):
    """Links between positions ``a`` and ``b`` of one block -> as few links that
    join the same positions, each run of a group in a chain (no hubs)."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    order = np.lexsort((nodes, label))
    same = label[order][1:] == label[order][:-1]
    return nodes[order][:-1][same], nodes[order][1:][same]
