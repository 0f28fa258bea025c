"""Connected components of a link table, as joins and grouped minima.

Alternating large-star and small-star steps; every step is a grouped minimum (combined before its
shuffle) and an equi-join whose other side has one row per node, so a node with very many links
is split by adaptive execution. Each round is a written table; links are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import written


def _star(links: DataFrame, small: bool) -> DataFrame:
    """links (a > b). Large star: each node's larger neighbours point to its least neighbour.
    Small star: each node and its lesser neighbours point to the least of them."""
    if small:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        both = links.join(least, "a")
        out = both.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    else:
        sym = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = sym.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a > b").distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link at most on its larger side and none on both sides."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every linked id but each component's least, from links (a, b)."""
    links = written(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(links):
        links = written(_star(_star(links, False), True), "links")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
