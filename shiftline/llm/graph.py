"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the smallest node it reaches.

    Alternating large and small stars: each node ties its larger neighbours,
    then its smaller ones, to the smallest neighbour it knows, until all
    nodes hang on their smallest node. Every round is a few aggregations and
    joins by node and is written to the shared folder; the number of edges
    never grows. Minima are aggregated before they are shuffled and a hub's
    edges meet one row, so Spark can split a hot hub.
    """
    up, down = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = written(edges.where(F.col("a") != F.col("b")).select(up, down).distinct(), "stars")
    while not _settled(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _settled(stars: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none: then the stars are the components."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("ties"), F.lit(False).alias("holds")).unionByName(
        stars.select(F.col("v").alias("node"), F.lit(0).alias("ties"), F.lit(True).alias("holds")))
    nodes = ends.groupBy("node").agg(F.sum("ties").alias("ties"), F.max("holds").alias("holds"))
    return nodes.where((F.col("ties") > 1) | ((F.col("ties") > 0) & F.col("holds"))).isEmpty()
