"""All pairs inside buckets of any size, as bounded pieces of work.

A bucket of n rows is cut into ceil(n / size) blocks by a hash of the row; each pair of blocks is one
piece, so no task ever holds a whole hot bucket, and rows are repeated once per block of their bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pieces(rows: DataFrame, keys: list[str], item: str, size: int) -> DataFrame:
    """rows (keys.., item) -> rows of buckets with two or more, with columns own, the row's
    block, and lo and hi, the two blocks of the piece."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    of = F.ceil(F.col("_n") / size).cast("int")
    return (
        rows.join(counts, keys)
        .withColumn("_of", of)
        .withColumn("own", F.pmod(F.xxhash64(item, F.lit(7)), F.col("_of")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
        .withColumn("lo", F.least("own", "_other"))
        .withColumn("hi", F.greatest("own", "_other"))
        .drop("_n", "_of", "_other")
    )


class Forest:
    """Union-find over positions; the root of a tree is its first position."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        root = np.array(self.parent, dtype=np.int64)
        while len(root) and (root != root[root]).any():
            root = root[root]
        return root

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """The trees as links of every position with its root: few rounds join such stars."""
        root = self.roots()
        leaf = np.flatnonzero(root != np.arange(len(root)))
        return leaf, root[leaf]
