"""Links between the members of cells, without all pairs of a large cell.

A similarity join deals its candidates into cells. Members of a cell of at most
``small`` are joined with each other. A larger cell is dealt into chunks of
about ``block`` members, and every pair of chunks is one group of bounded size;
there the members are compared block-wise, and only the links that connect what
was not connected before are kept (a spanning forest of the group's link graph).
So a cell of n near copies gives links in proportion to n times its chunks, not
n squared, and every two members that link are still connected.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def large_cells(cells: DataFrame, key: str, small: int) -> DataFrame:
    """(key, n) of the cells with more than ``small`` members."""
    return cells.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > small)


def spanning_links(cells: DataFrame, total: int, key: str, member: str,
                   prepare: Callable[[pd.DataFrame], Callable[[int], np.ndarray]], block: int = 1024) -> DataFrame:
    """(a, b): links that connect the members of each cell as all its links do.

    ``cells`` has ``key``, ``member``, the size ``n`` of the cell, and what
    ``prepare`` needs; it has about ``total`` rows. ``prepare(rows)(i)`` tells
    which of the rows after i link with row i. Cells of one chunk are dealt many
    to a group, so that small ones cost little."""
    chunks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64(member, F.lit(11)), chunks).cast("int")
    buckets = max(1, -(-total // (2 * block)))
    dealt = (cells.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
             .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("mine", "other")
             .withColumn("group", F.when(chunks == 1, F.pmod(F.xxhash64(key, F.lit(13)), F.lit(buckets)))
                         .otherwise(F.xxhash64(key, "lo", "hi"))))

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, some in rows.groupby([key, "lo", "hi"], sort=False):
            ids, f, near, apart = some[member].to_numpy(), Forest(len(some)), prepare(some), len(some) - 1
            for i in range(len(some) - 1):
                if not apart:
                    break  # all are connected
                for j in np.flatnonzero(near(i)).tolist():
                    if f.join(i, i + 1 + j):
                        out.append((ids[i], ids[i + 1 + j]))
                        apart -= 1
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("group").applyInPandas(forest, "a long, b long")
