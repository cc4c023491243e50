"""Connected components of a distributed list of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node reachable from each of n nodes over the links (a[i], b[i])."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node in links(a, b); root is the component's smallest node.

    Each round takes the smallest label among a node's neighbours, then that
    label's own label, so a chain of n nodes takes about log n rounds. Labels are
    pre-aggregated before each shuffle and joins are left to skew handling; only
    the number of changed labels reaches the driver.
    """
    both = materialise(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "root")
        seen = materialise(near.union(labels).groupBy("node").agg(F.min("root").alias("root")), "labels")
        up = seen.select(F.col("node").alias("root"), F.col("root").alias("top"))
        after = materialise(seen.join(up, "root").select("node", F.least("root", "top").alias("root")), "labels")
        settled = after.join(labels.withColumnRenamed("root", "was"), "node").where("root <> was").isEmpty()
        release(labels, seen)
        if settled:
            release(both)
            return after
        labels = after
