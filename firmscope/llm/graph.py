"""Connected components of a table of links, in rounds of joins and minima."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import stored


class Forest:
    """Union by smaller number over 0 .. n - 1, with path halving."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, k: int) -> int:
        up = self.up
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join many pairs at once: roots are hooked to smaller roots until no pair has two."""
        while len(a):
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))

    def roots(self, k: np.ndarray) -> np.ndarray:
        up = self.up
        x = up[k]
        while True:
            y = up[x]
            if np.array_equal(x, y):
                return x
            x = y


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    up = links.select(F.col("a").alias("node"), F.col("b").alias("big"))
    return up.join(least, F.col("node") == F.col("a")).select(F.col("big").alias("b"), F.col("m").alias("a"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    down = links.select(F.col("b").alias("node"), F.col("a").alias("small"))
    moved = down.join(least, F.col("node") == F.col("b")).select(F.col("small").alias("b"), F.col("m").alias("a"))
    return moved.union(least.select("b", F.col("m").alias("a")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all linked nodes: the root is the smallest node reachable.

    ``links`` has two columns of one orderable type. Large stars and small
    stars take turns until every node hangs on its root. Minima combine before
    the shuffle, and the joins' other side has a row per node, so Spark can
    split a node with very many links. Each round's links are written to the
    shared folder.
    """
    x, y = (F.col(c) for c in links.columns)
    links = links.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).filter("a < b").distinct()
    links = stored(links, "links")
    while True:
        turned = _large_star(links).select("a", "b").filter("a < b").distinct()
        turned = stored(_small_star(turned).select("a", "b").filter("a < b").distinct(), "links")
        if not _differ(links, turned):
            return turned.select(F.col("b").alias("node"), F.col("a").alias("root"))
        links = turned


def _differ(one: DataFrame, other: DataFrame) -> bool:
    """Whether the links changed: by their number and two sums of hashes, worked out in one pass each."""
    sums = [
        df.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
        ).first()
        for df in (one, other)
    ]
    return sums[0] != sums[1]
