"""Connected components of a link table, as repeated joins: no link or component leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable; nodes without links are left out.

    links: a, b (long).  Alternates the large-star and small-star steps until
    every link points at the smallest node of its component; the table is cut
    after every round.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = materialize(pairs, "cc")
    while not _are_stars(pairs):
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_low.select("u", F.col("m").alias("v")))
        pairs = materialize(small.filter("u <> v").distinct(), "cc", pairs)
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every u has one v and no v is a u; as v < u, each v is then the smallest node of its component."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("out")).union(pairs.select("v", F.lit(0)))
    of_node = ends.groupBy("node").agg(F.sum("out").alias("outs"), F.min("out").alias("leaf"))
    return of_node.filter("outs > 1 or (outs = 1 and leaf = 0)").isEmpty()
