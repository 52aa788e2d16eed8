"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b`` of one type); ``root`` is the smallest node reachable.

    Alternating large and small stars: every round hangs the neighbours of a node on
    its smallest neighbour, until each component is one star.  A round is two
    aggregations and two joins on a node, so a node with many edges is pre-aggregated
    and split by the skew join; rounds are written, so no lineage builds up.
    """
    pairs = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct()
    stars, mark = _round_written(pairs)
    while True:
        both = stars.union(stars.select(F.col("u").alias("v"), F.col("v").alias("u"))).toDF("node", "other")
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("m"))
        large = both.join(least, "node").where("other > node").select(F.col("other").alias("node"), "m").distinct()
        lower = large.groupBy("node").agg(F.min("m").alias("root"))
        small = large.join(lower, "node")
        grown = small.select(F.col("node").alias("v"), F.col("root").alias("u")).union(
            small.where("m <> root").select("m", "root")
        )
        stars, new_mark = _round_written(grown.distinct())
        if new_mark == mark:
            break
        mark = new_mark
    roots = stars.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return stars.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)


def _round_written(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    table = written(pairs, "stars")
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return table, tuple(table.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), total).first())
