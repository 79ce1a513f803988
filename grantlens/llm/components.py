"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import saved


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (src, dst): root is the smallest node reachable.

    Each round lets every node's larger neighbours, then its smaller ones,
    point at the smallest node seen from there. A node's neighbours are never
    gathered: only their minimum is, and a hot node's edges can be split in
    the join. Rounds grow with the logarithm of the longest path.
    An empty edge table gives an empty result; null ends and loops are ignored.
    """
    now = saved(
        edges.filter("src <> dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(),
        "edges",
    )
    before = _state(now)
    while True:
        now = saved(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m"))
    least = least.select("src", F.least("src", "m").alias("m"))
    return both.filter("dst > src").join(least, "src").select(
        F.col("dst").alias("src"), F.col("m").alias("dst")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.distinct()
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    moved = edges.join(least, "src").filter("dst <> m").select(
        F.col("dst").alias("src"), F.col("m").alias("dst")
    )
    return moved.unionByName(least.select("src", F.col("m").alias("dst"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()
    return tuple(row)
