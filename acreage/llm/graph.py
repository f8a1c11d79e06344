"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import stored


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.shiftright(F.xxhash64("u", "v"), 20)), F.lit(0))).first()
    return row[0], row[1]


def _neighbours_to_smallest(edges: DataFrame) -> DataFrame:
    """Each node points the neighbours above it to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _self_to_smallest(edges: DataFrame) -> DataFrame:
    """Each node keeps one link down, to its smallest neighbour; the other neighbours below are linked there too."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge; the root is the smallest node reachable.

    ``edges`` has two long columns ``a`` and ``b``; direction, repeats, loops and nulls do not matter. Every round writes
    its edges to the shared folder; only their count and a check sum come to the driver. Rounds grow with the logarithm of
    the longest path. No group of neighbours is ever gathered: rounds consist of minimum aggregates and joins.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(e, "edges")
    mark = _mark(e)
    while mark[0]:
        e = stored(_self_to_smallest(_neighbours_to_smallest(e)), "edges")
        last, mark = mark, _mark(e)
        if last == mark:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
